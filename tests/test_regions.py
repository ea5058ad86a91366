"""The interval join gives what comparing all pairs does, by equal bins."""

import random

import pytest
from pyspark.sql import functions as F

from genoframe import join_regions

VARIANTS = "contig string, start bigint, end bigint, name int"
REGIONS = "contig string, start bigint, end bigint, label string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def random_tables(seed, n=400, m=120):
    pick = random.Random(seed)
    reach = [60, 5_000, 400_000, 1 << 33]
    variants, regions = [], []
    for i in range(n):
        start = pick.randrange(pick.choice(reach))
        length = pick.choice([1, 1, 1, 2, 30, 20_000, 300_000])
        variants.append((pick.choice(["1", "2", "X"]), start, start + length, i))
    for i in range(m):
        start = pick.randrange(pick.choice(reach)) - 5
        length = pick.choice([0, 1, 40, 1 << 14, 1 << 17, 1 << 20, 1 << 34, -3])
        regions.append((pick.choice(["1", "2", "3"]), start, start + length, f"r{i}"))
    regions += [regions[0], (None, 1, 2, "no contig"), ("1", None, 5, "open"), ("1", 5, None, "open")]
    regions += [("1", -(1 << 63), (1 << 63) - 1, "everything"), ("2", -(1 << 62), 1 << 62, "most")]
    return variants, regions


def pairs(variants, regions, overlap):
    found = []
    for contig, start, end, name in variants:
        for c, a, b, label in regions:
            if c != contig or a is None or b is None:
                continue
            if (start < b and end > a and a < b) if overlap else (start >= a and end <= b):
                found.append((name, label))
    return sorted(found)


@pytest.mark.parametrize("overlap", [False, True])
@pytest.mark.parametrize("most", [0, 1 << 26])
@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs(spark, overlap, most, seed):
    variants, regions = random_tables(seed)
    joined = join_regions(
        spark.createDataFrame(variants, VARIANTS), spark.createDataFrame(regions, REGIONS),
        overlap=overlap, max_broadcast_bytes=most, hot_variants=7,
    )
    assert joined.columns == ["contig", "start", "end", "name", "region"]
    found = sorted(tuple(r) for r in joined.select("name", "region.label").collect())
    assert found == pairs(variants, regions, overlap)


@pytest.mark.parametrize("most", [0, 1 << 26])
def test_plan_has_no_pairs_of_all(spark, most):
    variants, regions = random_tables(3)
    joined = join_regions(
        spark.createDataFrame(variants, VARIANTS), spark.createDataFrame(regions, REGIONS),
        overlap=True, max_broadcast_bytes=most,
    )
    text = plan(joined)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert ("ShuffledHashJoin" in text) == (most == 0)


def test_hot_bin_is_split(spark):
    """All variants lie in one bin: its rows go to several tasks."""
    variants = spark.range(20_000).selectExpr("'1' AS contig", "id % 50 AS start", "id % 50 + 1 AS end", "int(id) AS name")
    regions = spark.createDataFrame([("1", 0, 25, "left"), ("1", 25, 60, "right")], REGIONS)
    joined = join_regions(variants, regions, max_broadcast_bytes=0, hot_variants=1_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        by_task = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in by_task) == 20_000
    assert len(by_task) == 4 and max(r["count"] for r in by_task) < 12_000


def test_names_and_extra_columns(spark):
    variants = spark.createDataFrame([("1", 5, 6, 1)], VARIANTS).withColumn("label", F.lit("mine"))
    regions = spark.createDataFrame([("1", 0, 9, "r")], "chrom string, chromStart int, chromEnd int, label string")
    joined = join_regions(variants, regions, contig="chrom", start="chromStart", end="chromEnd")
    row = joined.first()
    assert (row["label"], row["region"]["label"], row["region"]["chromEnd"]) == ("mine", "r", 9)
    assert join_regions(variants, regions.where("false"), contig="chrom", start="chromStart", end="chromEnd").count() == 0
