"""Near-duplicate components."""

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing, documents, random_texts, rows_of

from genoframe.llm import jaccard
from genoframe.llm.jaccard import Forest
from genoframe.llm.shingles import shingle_sets


def brute_set(text, words):
    tokens = (text or "").encode().lower().split()
    grams = {tuple(tokens[i : i + words]) for i in range(len(tokens) - words + 1)}
    return grams or ({tuple(tokens)} if tokens else set())


def brute(rows, words, percent):
    sets = [brute_set(text, words) for _, text in rows]
    forest = Forest()
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                forest.link(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = forest.root(i)
        least[root] = min(least.get(root, doc_id), doc_id)
    return sorted((d, len(sets[i]), least[forest.root(i)]) for i, (d, _) in enumerate(rows))


def edited(text, pick, edits):
    words = text.split()
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"x{pick.randrange(10**6)}"
    return " ".join(words)


def family(n, length, edits, seed):
    """Near copies of one text, with 0 to ``edits`` words replaced."""
    pick = random.Random(seed)
    base = " ".join(f"w{pick.randrange(5000)}" for _ in range(length))
    return [edited(base, pick, pick.randint(0, edits)) for _ in range(n)]


def shuffled(texts, seed):
    ids = random.Random(seed).sample(range(10 * len(texts)), len(texts))
    return list(zip(ids, texts))


CORPORA = {
    "families": [t for s in range(12) for t in family(9, 90, 5, s)] + random_texts(60, 1),
    "one family": family(120, 60, 4, 99),
    "short": ["a", "A", "a b", "A  b", "b a", "a b c", "a b c d", "", None, " ", "é a b"] * 2,
    "shared passage": [
        " ".join(f"p{k}" for k in range(60)) + " " + " ".join(f"q{i}_{k}" for k in range(i))
        for i in range(0, 60, 2)
    ],
}


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("name", CORPORA)
def test_equals_brute_force(spark, name, words, percent):
    rows = shuffled(CORPORA[name], 7)
    found = jaccard.near_duplicates(documents(spark, rows).repartition(4), words, percent)
    assert rows_of(found) == sorted(brute(rows, words, percent), key=repr)


@pytest.mark.parametrize("leaders", [1, 4])
def test_large_clusters_are_cut_into_chunks(spark, monkeypatch, leaders):
    monkeypatch.setattr(jaccard, "CHUNK_NODES", 16)
    monkeypatch.setattr(jaccard, "LEADERS", leaders)
    loose = family(40, 60, 9, 5)
    rows = shuffled(CORPORA["one family"] + CORPORA["families"] + loose, 3)
    found = jaccard.near_duplicates(documents(spark, rows).repartition(4))
    assert rows_of(found) == sorted(brute(rows, 3, 90), key=repr)


@pytest.mark.parametrize("percent", [50, 80, 90, 99, 100])
def test_sets_that_link_share_a_part(percent):
    """Random pairs right at the bound, with sets from one member on."""
    rng = np.random.default_rng(percent)
    for _ in range(600):
        n = int(rng.integers(1, 40) if rng.random() < 0.6 else rng.integers(40, 700))
        values = np.unique(rng.integers(0, 1 << 63, size=4 * n, dtype=np.uint64))
        base = rng.permutation(values)
        x = set(base[:n].tolist())
        y, fresh = set(x), iter(base[n:].tolist())
        while True:
            changed = set(y)
            if changed and rng.random() < 0.5:
                changed.discard(next(iter(changed & x or changed)))
            if rng.random() < 0.5:
                changed.add(next(fresh))
            if not changed or 100 * len(x & changed) < percent * len(x | changed):
                break
            if changed == y and percent == 100:
                break
            y = changed
            if len(y) > 2 * n:
                break
        frequent = rng.random(1 << jaccard.SKETCH_BITS) < rng.choice([0, 0.3, 0.9, 1])
        keys = [
            jaccard.part_keys(np.array(sorted(s), dtype=np.uint64), percent, frequent)
            for s in (x, y)
        ]
        assert len(np.intersect1d(*keys)), (percent, len(x), len(y), len(x & y))


def test_odd_tables(spark):
    assert jaccard.near_duplicates(documents(spark, [])).collect() == []
    rows = [(4, None), (4, None), (7, "a b c d"), (7, "a b c d"), (None, "a b c d"), (None, None)]
    docs = clashing(documents(spark, rows))
    assert rows_of(jaccard.near_duplicates(docs)) == sorted(
        [(4, 0, 4), (4, 0, 4), (7, 2, 7), (7, 2, 7), (None, 2, 7), (None, 0, None)], key=repr
    )
    kept = jaccard.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert kept.count() == 6


def test_keep_one_of_each_component(spark):
    rows = shuffled(CORPORA["families"], 5)
    kept = jaccard.keep_one_per_component(documents(spark, rows), 3, 90)
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in brute(rows, 3, 90)}


@pytest.mark.parametrize("budget", [64, 1 << 20])
def test_product_of_blocks(monkeypatch, budget):
    monkeypatch.setattr(jaccard, "ENTRIES_PER_BLOCK", budget)
    texts = [t for t in CORPORA["one family"] + random_texts(50, 2) if t and t.split()]
    sets = sorted(shingle_sets(pa.array(texts), 3), key=len)
    counts = jaccard.overlaps(sets[:40], sets[30:])
    for i, a in enumerate(sets[:40]):
        for j, b in enumerate(sets[30:]):
            assert counts[i, j] == len(np.intersect1d(a, b))
    pairs = set(jaccard.linked(sets, 90, rows=16))
    plain = {
        (i, j)
        for j in range(len(sets))
        for i in range(j)
        if 100 * (c := len(np.intersect1d(sets[i], sets[j]))) >= 90 * (len(sets[i]) + len(sets[j]) - c)
    }
    assert pairs == plain


def test_one_row_carries_a_set():
    """The filter holds one carrier of each set: its copies in other tasks stay there."""
    base = family(1, 40, 0, 8)[0]
    (members,) = shingle_sets(pa.array([base]), 3)
    node = np.array([jaccard._node(jaccard._digest(members))])
    bits, carrier = 16, 5
    found = np.zeros(1 << bits, dtype=bool)
    found[jaccard._bits(node, np.array([carrier]), bits)] = True
    task = jaccard._whole_sets(3, bits, np.packbits(found))
    for ids in ([90, 5, 70, 5], [8, 9, 11]):
        batch = pa.RecordBatch.from_pydict(
            {"carrier": pa.array(ids, pa.int64()), "text": pa.array([base] * len(ids))}
        )
        sent = [row for out in task(iter([batch])) for row in out.to_pylist()]
        assert [row["carrier"] for row in sent] == [carrier] * (carrier in ids)


def test_hot_digests_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_SHARE", 4)
    rows = spark.createDataFrame([(i, b"h" if i % 2 else bytes([i])) for i in range(20)], "i int, digest binary")
    by_digest = rows.groupBy("digest").count().withColumnRenamed("count", "copies")
    found = jaccard._with_hot(rows, by_digest, 20)
    assert rows_of(found.select("i", "copies")) == sorted(
        ((i, 10 if i % 2 else 1) for i in range(20)), key=repr
    )
