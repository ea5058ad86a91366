"""Save parsed variants as tables and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_variants(
    df: DataFrame,
    table: str,
    mode: str = "errorifexists",
    partitions: int | None = None,
    path: str | None = None,
    balanced: bool = False,
) -> None:
    """Save as a table, which by default must not exist yet.

    ``partitions`` redistributes the rows first, which evens out files of very
    different sizes, above all gzip files, which cannot be split. ``balanced`` does so
    without a number: Spark measures the bytes and makes files of its advisory size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``). With ``path`` the table is
    external and its files lie there.
    """
    rows = df if partitions is None else df.repartition(partitions)
    if balanced:
        rows = rows.hint("rebalance")
    writer = rows.write.mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def read_variants(spark: SparkSession, table: str) -> DataFrame:
    """Read a saved table back."""
    return spark.read.table(table)
