"""Bring each file's selected samples to its lines.

Files of one cohort share one header, so lines first get the key of their file's
header and then, by the key, its samples. Both tables are measured before they are
broadcast; beyond the bound they are joined with salts. Results are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.options import VcfOptions
from genoframe.sources.headers import (
    StoredHeaders,
    headers_from_heads,
    headers_from_sample_ids,
    kept_by_key,
    sample_ids,
    stored,
)
from genoframe.sources.heads import has_header_udf, kept_samples_udf
from genoframe.sources.paths import VcfPath

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Tasks that one file's lines spread over when a header join has to shuffle.
SALTS = 64


def _join(lines: DataFrame, table: DataFrame, key: str, size: int, most: int) -> DataFrame:
    """Inner join of lines and a small table; lines without a partner drop out."""
    if size <= most:
        return lines.join(F.broadcast(table), key)
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    # The hint keeps Spark from broadcasting on an estimate.
    spread = table.select("*", salts).hint("shuffle_hash")
    return salted.join(spread, [key, "salt"]).drop("salt")


def _kept_size(kept: DataFrame) -> int:
    names = "aggregate(kept, 0L, (n, s) -> n + octet_length(s.sampleId) + 32)"
    return kept.agg(F.sum(F.expr(f"64 + {names}")).alias("n")).first()["n"] or 0


def _join_stored(
    lines: DataFrame, headers: StoredHeaders, options: VcfOptions, max_broadcast_bytes: int
) -> DataFrame:
    """Bring keys and samples to the lines. The stored names bound the size of the
    samples; only where they are over the bound, the samples are stored and measured."""
    keys = headers.rows.select(headers.key, "header_key")
    kept = kept_by_key(headers.rows, options)
    kept_size = headers.names_size
    if kept_size > max_broadcast_bytes:
        kept = stored(kept, "samples")
        kept_size = _kept_size(kept)
    keyed = _join(lines, keys, headers.key, headers.keys_size, max_broadcast_bytes)
    return _join(keyed, kept, "header_key", kept_size, max_broadcast_bytes).drop("header_key")


def join_headers(
    lines: DataFrame,
    headers: DataFrame,
    options: VcfOptions,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join a table of file key and ``sample_ids``, which is evaluated once."""
    return _join_stored(lines, headers_from_sample_ids(headers), options, max_broadcast_bytes)


def join_headers_once(
    lines: DataFrame,
    headers: StoredHeaders,
    options: VcfOptions,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The same for headers that are stored already."""
    return _join_stored(lines, headers, options, max_broadcast_bytes)


def join_scanned_headers(
    records: DataFrame,
    lines: DataFrame,
    options: VcfOptions,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join headers found by scanning ``lines``, once."""
    return join_headers(records, sample_ids(lines), options, max_broadcast_bytes)


def join_head_headers(
    records: DataFrame,
    lines: DataFrame,
    source: VcfPath,
    options: VcfOptions,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join headers read from the file heads, each file's head being opened once."""
    return _join_stored(records, headers_from_heads(lines, source), options, max_broadcast_bytes)


def look_up_headers(records: DataFrame, options: VcfOptions) -> DataFrame:
    """Each task reads the heads of the files whose lines it holds: no join, no shuffle.

    For streams, which meet files that are not there yet. The samples are a column
    of their own, so a query that reads no genotypes does not carry them.
    """
    known = records.where(has_header_udf()("file_uri"))
    return known.withColumn("kept", kept_samples_udf(options)("file_uri"))
