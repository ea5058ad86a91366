"""Mixing sources to target weights."""

import math
import random

import pytest
from helpers import clashing, documents, rows_of

from genoframe.llm import mixing


def brute_targets(sizes, most=3):
    """Targets by sharing again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    capped = {}
    while True:
        free = [s for s in order if s not in capped]
        left = sum(sizes.values()) - sum(capped.values())
        total = sum(weight[s] for s in free)
        target = {s: left * weight[s] / total for s in free}
        above = [s for s in free if target[s] > most * sizes[s] + 1e-9]
        if not above:
            return target | capped
        capped |= {s: float(most) * sizes[s] for s in above}


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_repeated_sharing(spark, seed):
    pick = random.Random(seed)
    sizes = {f"s{i:02}": pick.choice([0, 1, 5, 40, 900]) for i in range(11)} | {None: 30}
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())]
    found = mixing.assign_copies(documents(spark, rows)).collect()
    expected = brute_targets(sizes)
    for row in found:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(expected[row["source"]], abs=1e-6)


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "abc"[0 if i % 3 else 1 + i % 2]) for i in range(6000)]
    found = mixing.assign_copies(documents(spark, rows)).collect()
    for source in "abc":
        own = [r for r in found if r["source"] == source]
        taken = sum(r["size"] * r["copies"] for r in own)
        assert taken == pytest.approx(own[0]["target"], rel=0.06)
        rate = own[0]["target"] / own[0]["source_size"]
        assert {r["copies"] for r in own} <= {math.floor(rate), math.floor(rate) + 1}
        assert max(r["copies"] for r in own) <= 3


def test_mix_emits_the_copies_with_all_columns(spark):
    rows = [(i, "a b c" if i % 4 else None, f"s{i % 5}") for i in range(200)] + [(None, "x", None)]
    docs = clashing(documents(spark, rows))
    copies = {r["doc_id"]: r["copies"] for r in mixing.assign_copies(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    found = rows_of(mixed)
    assert len(found) == sum(copies.values())
    for row in rows_of(docs):
        assert found.count(row) == copies[row[0]]
    assert found == rows_of(mixing.mix(docs))


def test_many_sources_take_the_salted_way(spark, monkeypatch):
    docs = documents(spark, [(i, "w " * i, f"s{i % 7}" if i % 9 else None) for i in range(80)])
    expected = rows_of(mixing.assign_copies(docs))
    mixed = rows_of(mixing.mix(docs))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert rows_of(mixing.assign_copies(docs)) == expected
    assert rows_of(mixing.mix(docs)) == mixed


@pytest.mark.parametrize("most", [1, 2, 5])
def test_targets_and_copies_end_at_the_same_repeats(spark, most):
    rows = [(i, "w " * (i % 3), "b") for i in range(60)] + [(100 + i, "w " * 90, "a") for i in range(40)]
    docs = documents(spark, rows)
    found = mixing.assign_copies(docs, most).collect()
    expected = brute_targets({"a": 3600, "b": 60}, most)
    for row in found:
        assert row["target"] == pytest.approx(expected[row["source"]])
        if row["source"] == "b":
            assert row["copies"] == most
    assert mixing.mix(docs, most).count() == sum(row["copies"] for row in found)


def test_empty_and_blank(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    blank = mixing.assign_copies(documents(spark, [(1, None), (2, " "), (2, " ")])).collect()
    assert [(r["size"], r["target"], r["copies"]) for r in blank] == [(0, 0.0, 0)] * 3
