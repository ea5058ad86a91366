"""Connected components."""

import random

import pytest

from genoframe.llm.components import components
from genoframe.llm.jaccard import Forest


def brute(edges):
    forest = Forest()
    for u, v in edges:
        forest.link(u, v)
    return sorted((x, forest.root(x)) for x in {x for e in edges if e[0] != e[1] for x in e})


CHAIN = [(i, i + 1) for i in range(40)]
CASES = {
    "none": [],
    "loops": [(3, 3)],
    "chain": CHAIN,
    "star": [(500, i) for i in range(300)],
    "repeated": [(2, 1), (1, 2), (2, 1), (9, 8)],
    "negative": [(-5, 3), (3, 7), (-9, 7)],
    "random": [(random.Random(1).randrange(10**6 + i) % 300, i % 290) for i in range(240)],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_union_find(spark, name):
    edges = spark.createDataFrame(CASES[name], "u bigint, v bigint")
    assert sorted(map(tuple, components(edges).collect())) == brute(CASES[name])


def test_rounds_end_only_when_settled(spark):
    edges = [(i, i + 1) for i in range(700)]
    found = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(found) == 701 and {row["root"] for row in found} == {0}
