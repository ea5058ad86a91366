"""Tables that regions prune."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from genoframe import in_region, info_field, read_vcf, region_from_table, save_by_region
from genoframe.operators.layout import MANIFEST, region_files

SCHEMA = "contig string, start bigint, end bigint, referenceAllele string, n bigint"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = spark.range(30_000).selectExpr(
        "concat('chr', id % 3) AS contig", "(id * 7919) % 1000000 AS start",
        "(id * 7919) % 1000000 + 1 + id % 5 AS end", "repeat('A', int(1 + id % 5)) AS referenceAllele", "id AS n",
    )
    folder = str(tmp_path_factory.mktemp("layout") / "by region %+")
    save_by_region(rows, folder, partitions=16)
    return rows, folder


@pytest.mark.parametrize(
    ("contig", "start", "end"),
    [("chr1", 0, 2_000_000), ("chr0", 400_000, 410_000), ("chr2", 5, 6), ("chr2", 999_000, 9_999_999), ("chr7", 0, 9)],
)
def test_rows_of_a_region(spark, table, contig, start, end):
    rows, folder = table
    found = region_from_table(spark, folder, contig, start, end)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, in_region(rows, contig, start, end).collect()))


def test_few_files_are_read(spark, table):
    _, folder = table
    every = spark.read.parquet(folder).select("_metadata.file_path").distinct().count()
    near = region_files(spark, folder, "chr0", 400_000, 410_000).count()
    assert every == 16 and near <= 2
    read = region_from_table(spark, folder, "chr0", 400_000, 410_000)
    assert len(read.inputFiles()) == near
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(contig)" in scan


def test_manifest_and_order(spark, table):
    _, folder = table
    manifest = spark.read.parquet(f"{folder}/{MANIFEST}")
    assert manifest.agg(F.sum("variants")).first()[0] == 30_000
    # Ranges of one contig do not overlap by more than a place.
    ranges = sorted(map(tuple, manifest.select("contig", "min_start", "max_end").collect()))
    for (c, _, last), (d, first, _) in zip(ranges, ranges[1:]):
        assert c != d or first >= last - 1024 - 5


def test_one_place_with_most_rows(spark, tmp_path):
    """A place that outgrows a file spreads over several."""
    rows = spark.range(8_000).selectExpr("'chrM' AS contig", "7L AS start", "8L AS end", "'A' AS referenceAllele", "id AS n")
    save_by_region(rows, str(tmp_path / "t"), partitions=8)
    sizes = [r["variants"] for r in spark.read.parquet(str(tmp_path / "t" / MANIFEST)).collect()]
    assert len(sizes) == 8 and max(sizes) < 3_000
    assert region_from_table(spark, str(tmp_path / "t"), "chrM", 7, 8).count() == 8_000


def test_vcf_rows_modes_and_empty(spark, tmp_path, cohort):
    folder = str(tmp_path / "t")
    save_by_region(read_vcf(spark, cohort), folder)
    found = region_from_table(spark, folder, "chr1", 10, 11)
    assert [tuple(r) for r in found.select("start", info_field("DP", "int")).collect()] == [(10, 7)]
    with pytest.raises(AnalysisException):
        save_by_region(read_vcf(spark, cohort), folder)
    save_by_region(read_vcf(spark, cohort).where("false"), folder, mode="overwrite")
    assert region_from_table(spark, folder, "chr1", 10, 11).count() == 0
