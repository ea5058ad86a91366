"""Exact duplicates by content sort."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from helpers import clashing, documents, random_texts, rows_of

from genoframe.llm import exact


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[norm(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, digest) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


CASES = {
    "mixed": list(enumerate(["a b", "a  b", "a\tb", "b a", None, "", " ", "\n\n", "a\xa0b"])),
    "hot": [(i, "same text" if i % 3 else f"text {i % 40}") for i in range(3000, 0, -1)],
    "long": [(i, "word " * 60_000 + str(i % 2)) for i in range(6)],
    "repeated": [(1, "x"), (1, "x"), (2, "x"), (2, "y"), (2, "y"), (None, "y"), (None, None)],
    "same head": [(i, "h" * 100 + str(i % 7)) for i in range(50)],
    "random": list(enumerate(random_texts(300, 5, ["a", "b"]))),
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_brute_force(spark, name):
    found = exact.exact_duplicates(documents(spark, CASES[name]).repartition(5))
    assert rows_of(found) == brute(CASES[name])


@pytest.mark.parametrize("name", CASES)
def test_drop_keeps_one_row_of_each_text(spark, name):
    docs = clashing(documents(spark, CASES[name])).repartition(3)
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    found = Counter(norm(r["text"]) for r in kept.collect())
    assert set(found.values()) <= {1}
    smallest = {r[1:2] + r[4:] for r in brute(CASES[name]) if r[3]}
    texts = {hashlib.sha256(norm(r["text"]).encode()).hexdigest(): r["doc_id"] for r in kept.collect()}
    assert {(i, d) for d, i in texts.items()} == smallest


def test_a_text_over_many_ranges(spark):
    """More ranges than texts: every range boundary lies inside a run."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [(i, "only one") for i in range(4000)] + [(5000 + i, "two") for i in range(9)]
        docs = documents(spark, rows)
        assert rows_of(exact.exact_duplicates(docs)) == brute(rows)
        assert {r["doc_id"] for r in exact.drop_exact_duplicates(docs).collect()} == {0, 5000}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("column", ["doc_id", exact.ROW])
def test_ranges_are_sorted_by_whole_texts(spark, column):
    docs = documents(spark, CASES["same head"])
    if column == exact.ROW:
        docs = docs.selectExpr(f"struct(*) AS {exact.ROW}")
    plan = exact._sorted_ranges(docs, column)._jdf.queryExecution().optimizedPlan().toString()
    keys = re.search(r"Sort \[(.*?)\], false", plan).group(1)
    names = [key.split(" ")[0] for key in keys.split(", ")]
    assert [name.split("#")[0] for name in names[:3]] == [exact.HEAD, exact.DIGEST, exact.NORM]
    assert len(names) == 4 and (names[3].startswith("doc_id#") or names[3].endswith(".doc_id"))


def test_equal_texts_meet_behind_a_long_common_head(spark):
    """Texts of many megabytes that differ in their last byte only."""
    rows = [(i, "x " * 1_500_000 + str(i % 3)) for i in range(9)]
    found = exact.exact_duplicates(documents(spark, rows).repartition(4))
    assert rows_of(found) == brute(rows)
