"""Fill-in-middle cuts against a scanner that walks over the characters."""

import hashlib
import random

import pytest
from helpers import clashing, documents, random_texts, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from genoframe.llm import fim

WHITE = set(" \t\n\v\f\r")


def plain_units(text):
    """Units by walking: white space up to a word and the word, or what is left."""
    units, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in WHITE:
            end += 1
        while end < len(text) and text[end] not in WHITE:
            end += 1
        units.append(text[at:end])
        at = end
    return units


def expected(doc_id, text):
    text = text or ""
    units = plain_units(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if h4 % 100 < 80:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, form, len(prefix), len(middle), sha(output), sha(text))


@given(st.text(alphabet=" \t\n\r\x0b\x0cabé　\x85\U0001f600<P>SM", max_size=60))
@settings(max_examples=300, deadline=None)
def test_units(text):
    units = plain_units(text)
    ends = [sum(map(len, units[: i + 1])) for i in range(len(units))]
    assert fim.unit_ends(text) == ends
    assert fim.unit_ends(text, stretch=3) == ends


@pytest.mark.parametrize("doc_id", [*range(40), None])
def test_forms_are_undone(doc_id):
    text = " a\n bé  c\td e "
    parts = fim.cut(doc_id, text)
    assert fim.restore(parts.output(), parts.form) == text
    assert parts.prefix + parts.middle + parts.suffix == text


def test_query_rows(spark):
    texts = random_texts(200, 5)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(7, "twice"), (7, "twice"), (None, "no id"), (500, None), (501, ""), (502, " \n ")]
    rows += [(i, f"with a {mark} mark") for i, mark in enumerate(("<P>", "<S>", "<M>", "<p>"), 600)]
    docs = clashing(documents(spark, rows))
    found = fim.fill_in_middle(docs, digests=True)
    assert rows_of(found) == sorted((expected(*row) for row in rows), key=repr)
    assert {r[2] for r in rows_of(found)} == {"plain", "psm", "spm"}


def test_outputs(spark):
    rows = [(i, f"one two three {i}") for i in range(60)]
    for row in fim.fill_in_middle(documents(spark, rows)).collect():
        assert fim.restore(row["output"], row["form"]) == f"one two three {row['doc_id']}"
    every = fim.fill_in_middle(documents(spark, rows), changed=100, suffix_first=0).collect()
    assert {row["form"] for row in every} == {"psm"}


def test_very_long_texts(spark):
    long_id = next(i for i in range(99) if expected(i, "a b")[2] != "plain")
    rows = [(long_id, "word é\n" * 2_000_000), (long_id, "x" * 9_000_000), (long_id, " " * 9_000_000)]
    found = rows_of(fim.fill_in_middle(documents(spark, rows), digests=True))
    assert found == sorted((expected(*row) for row in rows), key=repr)


def test_no_documents(spark):
    assert fim.fill_in_middle(documents(spark, []), digests=True).count() == 0
