"""Scan VCF files as lines.

A lines DataFrame has the columns ``value``, ``file_path`` and ``file_name``,
``file_uri`` to tell files apart, and ``file_block_start`` for the place of a
split in its file. Headers and records are both in it, so the same parser runs
on files, streams and any table that holds VCF lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.sources.paths import VcfPath

LINES_SCHEMA = (
    "value string, file_path string, file_name string, "
    "file_uri string, file_block_start bigint"
)


def _decoded(uri: Column) -> Column:
    """Undo the percent encoding of a file URI; ``+`` is an ordinary character."""
    unescaped = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(uri, F.lit("%")), unescaped).otherwise(uri)


def path_as_given(uri: Column, source: VcfPath) -> Column:
    """File path spelled the way the user spelled the root."""
    if source.is_file:
        return F.lit(source.given)
    below_root = F.substr(_decoded(uri), F.lit(len(source.root.rstrip("/")) + 1))
    return F.concat(F.lit(source.given.rstrip("/")), below_root)


def _with_file_columns(text: DataFrame, source: VcfPath) -> DataFrame:
    uri = F.col("_metadata.file_path")
    path = path_as_given(uri, source)
    return text.select(
        "value",
        path.alias("file_path"),
        F.substring_index(path, "/", -1).alias("file_name"),
        uri.alias("file_uri"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
    )


def empty_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LINES_SCHEMA)


def vcf_lines(spark: SparkSession, source: VcfPath | None) -> DataFrame:
    """Lines of every VCF file under the path; no lines for a missing path.

    Plain files are split, gzip files are decoded by their suffix.
    """
    if source is None:
        return empty_lines(spark)
    text = spark.read.options(**source.reader_options).text(source.load_path)
    return _with_file_columns(text, source)


def vcf_lines_stream(
    spark: SparkSession, source: VcfPath, stream_options: dict[str, object]
) -> DataFrame:
    """The same lines as a stream; new files are picked up as they appear."""
    text = (
        spark.readStream.options(**source.reader_options)
        .options(**stream_options)
        .text(source.stream_path)
    )
    return _with_file_columns(text, source)
