"""Variants as files that each hold one range of positions, and a manifest of the ranges.

A query for one region reads the manifest first and then the few files whose range may
hold it; the others are not opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.operators.variants import in_region
from genoframe.plans.shared import remove

# Folders whose names begin with an underscore are not data to Spark's readers.
MANIFEST = "_regions"
# Positions that a file boundary does not tell apart, so equal places stay together.
PLACE_BITS = 10


def save_by_region(
    df: DataFrame, path: str, partitions: int | None = None, mode: str = "errorifexists"
) -> None:
    """Write variants to ``path`` as Parquet, range-partitioned and sorted by place.

    ``partitions`` is the number of ranges; without it Spark's number of shuffle
    partitions counts, fewer where they would be small. Places with very many variants
    are split by their rows. The manifest in ``_regions`` has a row per file and contig
    with its first start and last end; it is written last, and reading needs it.
    """
    spread = F.xxhash64("start", "end", "referenceAllele", F.monotonically_increasing_id())
    placed = df.withColumns({"_place": F.call_function("shiftright", F.col("start"), F.lit(PLACE_BITS)), "_spread": spread})
    keys = ("contig", "_place", "_spread")
    ranged = placed.repartitionByRange(partitions, *keys) if partitions else placed.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions("contig", "start", "end").drop("_place", "_spread")
    ordered.write.mode(mode).parquet(path)
    spark = df.sparkSession
    # Names of files only: the folder may be moved.
    files = spark.read.schema(df.schema).parquet(path).select(
        F.col("_metadata.file_name").alias("file"), "contig", "start", "end"
    )
    manifest = files.groupBy("file", "contig").agg(
        F.min("start").alias("min_start"), F.max("end").alias("max_end"), F.count("*").alias("variants")
    )
    try:
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    except Exception:
        # Files without a manifest would look like a table of no variants.
        remove(spark, f"{path}/{MANIFEST}")
        raise


def region_files(spark: SparkSession, path: str, contig: str, start: int, end: int) -> DataFrame:
    """Files of ``save_by_region`` that may hold variants inside a region."""
    manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    near = (F.col("contig") == contig) & (F.col("min_start") <= end) & (F.col("max_end") >= start)
    return manifest.where(near).select("file").distinct()


def region_from_table(spark: SparkSession, path: str, contig: str, start: int, end: int) -> DataFrame:
    """The variants of ``in_region`` from files that ``save_by_region`` wrote.

    The driver gets the names of the files to read, as it does of every file it reads.
    """
    # The schema comes from the footer of one file.
    table = spark.read.parquet(path)
    files = [f"{path}/{row['file']}" for row in region_files(spark, path, contig, start, end).collect()]
    if not files:
        return table.where("false")
    return in_region(spark.read.schema(table.schema).parquet(*files), contig, start, end)
