"""Quality measures and the cascade."""

import re

import pytest
from helpers import clashing, documents, random_texts, rows_of

from genoframe.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(again),
    )


TEXTS = [
    None, "", " \n ", "a b c d e", "a b c d e a b c d e", "x " * 40, "one two three four\n" * 3,
    "# * $ % & | < > ok", "É è 中文 ç\n", "\r\n\t\x0b a \x0c b", "w" * 5000, "a b c d " * 300,
    *random_texts(60, 3), *random_texts(40, 4, ["a", "b"]),
]


def test_measures_equal_brute_force(spark):
    found = quality.quality(documents(spark, list(enumerate(TEXTS)))).collect()
    assert len(found) == len(TEXTS)
    for row in found:
        n, chars, symbols, lines, repeats = expected = brute(TEXTS[row["doc_id"]])
        assert tuple(row[1:6]) == expected
        assert row["base_failed"] == (n < 10 or 100 * repeats > 20 * n)
        assert row["kept"] == (row["rejected_by"] is None)
        assert not (row["kept"] and row["base_failed"])


def test_order_is_by_rejection_per_cost_and_leaves_the_verdict(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    rules = (
        quality.Rule("never", "false"),
        quality.Rule("dear", "length(regexp_replace(repeat(text, 100), '[a-c]+', '')) >= 0"),
        quality.Rule("cheap", "n_words < 20"),
    )
    order = [rule.name for rule in quality.ordered_rules(quality.measures(docs), rules)]
    assert order == ["cheap", "dear", "never"]
    kept = [
        {r["doc_id"]: r["kept"] for r in quality.quality(docs, tuple(some)).collect()}
        for some in (rules, rules[::-1])
    ]
    assert kept[0] == kept[1]


def test_plan_has_no_python(spark, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    quality.quality(docs).explain("formatted")
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_clean_text_stays_and_junk_goes(spark):
    clean = "The river of the town is in the hills and it was long with a bend that is wide."
    junk = [
        "Of%%% the*** town&&& is### in$$$ the%%% hills*** and&&& it### was$$$ long%%%",
        "one | two | three | four | five | six | seven | eight | nine | ten | eleven",
        "THE RIVER OF THE TOWN IS IN THE HILLS AND IT WAS LONG",
        "1 2 3 4 5 6 7 8 9 10 11 12 13",
    ]
    docs = documents(spark, list(enumerate([clean, *junk])))
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect()}
    assert kept == {0: True, 1: False, 2: False, 3: False, 4: False}


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "a b"), (1, "a b")]])
def test_odd_tables(spark, rows):
    docs = clashing(documents(spark, rows))
    assert len(rows_of(quality.quality(docs))) == len(rows)
