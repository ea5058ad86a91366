"""Batch reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from genoframe.operators.genotypes import explode_genotypes
from genoframe.options import VcfOptions
from genoframe.plans.header_join import (
    MAX_BROADCAST_BYTES,
    join_head_headers,
    join_scanned_headers,
)
from genoframe.plans.parse import genotype_rows, parsed_variants, record_lines, vcf_columns
from genoframe.plans.rejects import observed_records
from genoframe.schema import vcf_schema
from genoframe.sources.lines import vcf_lines
from genoframe.sources.paths import resolve


def read_vcf_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the file, or of all VCF files under a directory, before parsing."""
    return vcf_lines(spark, resolve(spark, path))


def read_vcf(
    spark: SparkSession,
    path: str,
    scan_headers: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    observation: Observation | None = None,
    **options: object,
) -> DataFrame:
    """Read a VCF file, or all ``*.vcf`` and ``*.vcf.gz`` files under a directory.

    Options: ``includeSampleIds``, ``excludeSampleIds`` (comma lists),
    ``includeFileMetadata`` (default true), ``generatePrimaryKey`` (default
    false). A missing path gives no rows.

    Sample ids come from the head of each file. ``scan_headers=True`` finds them
    with a second text scan instead, for storage that only the JVM can open; the
    reader does that by itself for the files that workers cannot open.

    An ``observation`` has the numbers of records and of dropped lines by reason after
    the first action, see ``observed_records``; for a missing path it stays empty.
    """
    parsed = VcfOptions.parse(options)
    staged = _staged(spark, path, scan_headers, max_broadcast_bytes, parsed, observation)
    if staged is None:
        return spark.createDataFrame([], vcf_schema())
    if observation is not None:
        # Counted once: rows of their own would count again.
        return vcf_columns(staged, parsed)
    return parsed_variants(staged, parsed)


def read_genotypes(
    spark: SparkSession,
    path: str,
    scan_headers: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    **options: object,
) -> DataFrame:
    """One row per record and selected sample, with a ``genotype`` struct.

    The rows of ``explode_genotypes(read_vcf(...))``, but samples are split off
    before they are parsed: prefer it for wide cohorts, and where only part of a
    genotype is read. Same options.
    """
    parsed = VcfOptions.parse(options)
    staged = _staged(spark, path, scan_headers, max_broadcast_bytes, parsed)
    if staged is None:
        return explode_genotypes(spark.createDataFrame([], vcf_schema()))
    return genotype_rows(staged, parsed)


def _staged(
    spark: SparkSession,
    path: str,
    scan_headers: bool,
    max_broadcast_bytes: int,
    options: VcfOptions,
    observation: Observation | None = None,
) -> DataFrame | None:
    """Records with the samples of their file; None for a missing path."""
    source = resolve(spark, path)
    if source is None:
        return None
    lines = vcf_lines(spark, source)
    records = record_lines(lines) if observation is None else observed_records(lines, observation)
    if scan_headers:
        return join_scanned_headers(records, lines, options, max_broadcast_bytes)
    return join_head_headers(records, lines, source, options, max_broadcast_bytes)
