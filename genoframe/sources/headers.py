"""Header tables: sample ids and ``##`` metadata per file."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from genoframe.functions.genotype import kept_samples
from genoframe.functions.text import let, strip
from genoframe.options import VcfOptions
from genoframe.plans.shared import remove_at_end, shared_path
from genoframe.sources.heads import HEADS_SCHEMA, META_SCHEMA, can_open, read_heads
from genoframe.sources.lines import path_as_given, vcf_lines
from genoframe.sources.paths import VcfPath, resolve

log = logging.getLogger(__name__)

# File heads that one task may open before more tasks are used.
FILES_PER_TASK = 64
# Files to scan for headers that are named in the scan's filter.
MAX_NAMED_FILES = 1000


def file_key(lines: DataFrame) -> str:
    """Column that tells the files of a lines DataFrame apart."""
    return "file_uri" if "file_uri" in lines.columns else "file_path"


def _sample_array(chrom_line: str) -> str:
    """Fields behind FORMAT; an empty array if there are none."""
    return let("f", f"split({strip(chrom_line)}, '\\t')", "slice(f, 10, size(f))")


def _line_order(lines: DataFrame) -> Column:
    """Orders the lines of one file: by split, then by place within the split."""
    within = F.monotonically_increasing_id()
    if "file_block_start" not in lines.columns:
        return F.struct(within)
    return F.struct(F.col("file_block_start"), within)


def sample_ids(lines: DataFrame) -> DataFrame:
    """One row per file with a ``#CHROM`` line: its key and ordered sample ids.

    The first such line counts. Files without one are absent, files whose line
    names no samples have an empty array.
    """
    key = file_key(lines)
    chrom_lines = lines.where(F.startswith("value", F.lit("#CHROM"))).select(
        key, "value", _line_order(lines).alias("line_order")
    )
    first = chrom_lines.groupBy(key).agg(F.min_by("value", "line_order").alias("value"))
    return first.select(key, F.expr(_sample_array("value")).alias("sample_ids"))


# One ``key=value`` of a structured line: a quoted value ends at the next quote without
# a backslash, so commas, brackets and equal signs in it are text; so does one in brackets.
ATTRIBUTE = r'(?:^|,)\s*([^=,"<>]+)=\s*("(?:[^"\\]|\\.)*(?:"|$)|\[[^\]]*\]|[^,"]*)'


def attributes(line: str) -> str:
    """SQL of the attributes of a ``##section=<...>`` line, as a map of texts.

    Quotes and the backslashes before quotes and backslashes are taken off. Of repeated
    keys the first counts. NULL for lines of another form.
    """
    body = rf"regexp_extract({line}, r'^##[^=]*=<(.*)>\s*$', 1)"
    unquoted = r"""CASE WHEN startswith(v, '"') THEN
      regexp_replace(regexp_replace(substr(v, 2), r'(?<!\\)((?:\\\\)*)"$', '$1'), r'\\(["\\])', '$1')
      ELSE trim(v) END"""
    values = f"transform(regexp_extract_all(body, r'{ATTRIBUTE}', 2), v -> {unquoted})"
    pairs = "arrays_zip(keys, vals)"
    firsts = f"filter({pairs}, (p, i) -> array_position(keys, p.keys) = i + 1)"
    made = let("vals", values, f"map_from_entries({firsts})")
    keys = f"transform(regexp_extract_all(body, r'{ATTRIBUTE}', 1), k -> trim(k))"
    found = let("body", body, let("keys", keys, made))
    return rf"CASE WHEN {line} RLIKE r'^##[^=]*=<.*>\s*$' THEN {found} END"


def _with_declarations(meta: DataFrame, keys: list[str]) -> DataFrame:
    """Add section, all attributes of structured lines, and their id, number and type."""

    def declared(name: str) -> Column:
        return F.nullif(F.col("attributes")[name], F.lit(""))

    known = meta.select(
        *keys,
        "line",
        F.regexp_extract("line", r"^##([^=]*)", 1).alias("section"),
        F.expr(attributes("line")).alias("attributes"),
    )
    return known.select(
        *keys, "line", "section",
        declared("ID").alias("id"),
        declared("Number").alias("number"),
        declared("Type").alias("type"),
        "attributes",
    )


def vcf_header(lines: DataFrame) -> DataFrame:
    """Distinct ``##`` lines per file of a lines DataFrame, with what they declare."""
    keys = list(dict.fromkeys([file_key(lines), "file_path"]))
    meta = lines.where(F.startswith("value", F.lit("##"))).select(
        *keys, F.expr(strip("value")).alias("line")
    )
    return _with_declarations(meta.distinct(), keys)


def stored(rows: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The rows, computed once and kept in the shared folder until the session ends, or
    in a folder that the caller removes."""
    spark = rows.sparkSession
    if folder is None:
        folder = shared_path(spark, name)
        remove_at_end(spark, folder)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def stored_and_measured(
    rows: DataFrame, name: str, folder: str | None = None, **metrics: Column
) -> tuple[DataFrame, dict[str, int]]:
    """The same with aggregates over the rows, found while they are written."""
    observation = Observation()
    observed = rows.observe(observation, *(column.alias(n) for n, column in metrics.items()))
    kept = stored(observed, name, folder)
    return kept, {n: value or 0 for n, value in observation.get.items()}


def _unsettled(heads: DataFrame, lines: DataFrame, problems: int) -> DataFrame | None:
    """Lines of the files whose heads settle nothing; None if there are none.

    A few names come to the driver and prune the scan to their files; more are joined.
    """
    if not problems:
        return None
    left = heads.where("problem IS NOT NULL").select("file_uri", "problem")
    log.warning("%d files are scanned for headers; %s: %s", problems, *left.first())
    if problems > MAX_NAMED_FILES:
        return lines.join(left.select("file_uri"), "file_uri", "left_semi")
    names = [row["file_uri"] for row in left.collect()]
    return lines.where(F.col("file_uri").isin(names))


def read_vcf_header(spark: SparkSession, path: str) -> DataFrame:
    """The same for the files under a path, from the file heads.

    Files whose heads workers cannot read, and such without a ``#CHROM`` line in
    them, are scanned.
    """
    source = resolve(spark, path)
    if source is None:
        return _with_declarations(
            spark.createDataFrame([], "file_path string, line string"), ["file_path"]
        )
    if can_open(source.root):
        scanned = vcf_header(vcf_lines(spark, source)).select("file_path", "line")
        return _with_declarations(scanned, ["file_path"])
    found = file_listing(spark, source).mapInArrow(read_heads(meta=True), META_SCHEMA)
    heads, measured = stored_and_measured(found, "meta", problems=F.count("problem"))
    meta = heads.where("line IS NOT NULL").select(
        path_as_given(F.col("file_uri"), source).alias("file_path"), "line"
    )
    unsettled = _unsettled(heads, vcf_lines(spark, source), measured["problems"])
    if unsettled is not None:
        scanned = vcf_header(unsettled).select("file_path", "line")
        meta = meta.union(scanned)
    return _with_declarations(meta, ["file_path"])


def with_key(headers: DataFrame) -> DataFrame:
    """Name each header by its sample ids, so files that share one share its name."""
    names = F.concat(F.size("sample_ids"), F.lit(":"), F.array_join("sample_ids", "\t"))
    return headers.withColumn("header_key", F.sha2(names, 256))


def _sizes(key: str) -> dict[str, Column]:
    """Bytes of the keys of all files, and of all names of samples that are stored."""
    names = "aggregate(sample_ids, 0L, (n, s) -> n + octet_length(s) + 32)"
    return {
        "keys_size": F.sum(F.octet_length(key).cast("bigint") + 64),
        "names_size": F.sum(F.expr(f"coalesce({names}, 0L) + 64")),
    }


@dataclass(frozen=True)
class StoredHeaders:
    """Header key of each file, and the sample ids of a key with at least one of its
    rows: (file key, header_key, sample_ids), stored, and bounds on their bytes."""

    rows: DataFrame
    key: str
    keys_size: int
    names_size: int


def headers_from_heads(lines: DataFrame, source: VcfPath) -> StoredHeaders:
    """The headers of every file that has one.

    Heads are opened in one job; only files that they do not settle are scanned, and
    where workers can open none, all are without trying.
    """
    if can_open(source.root):
        return headers_from_sample_ids(sample_ids(lines))
    files = file_listing(lines.sparkSession, source)
    found = files.mapInArrow(read_heads(), HEADS_SCHEMA)
    metrics = _sizes("file_uri") | {"problems": F.count("problem")}
    heads, measured = stored_and_measured(found, "heads", **metrics)
    settled = heads.where("problem IS NULL").drop("problem")
    unsettled = _unsettled(heads, lines, measured["problems"])
    if unsettled is None:
        return StoredHeaders(settled, "file_uri", measured["keys_size"], measured["names_size"])
    more = headers_from_sample_ids(sample_ids(unsettled))
    return StoredHeaders(
        settled.unionByName(more.rows), "file_uri",
        measured["keys_size"] + more.keys_size, measured["names_size"] + more.names_size,
    )


def headers_from_sample_ids(headers: DataFrame, folder: str | None = None) -> StoredHeaders:
    """The same from a table of file key and ``sample_ids``, evaluated once."""
    key = file_key(headers)
    rows, measured = stored_and_measured(with_key(headers), "headers", folder, **_sizes(key))
    return StoredHeaders(rows, key, measured["keys_size"], measured["names_size"])


def file_listing(spark: SparkSession, source: VcfPath) -> DataFrame:
    """One row per file. No content is read: only its path is selected.

    Coalesced, since opening a file head is far too little work for a task.
    """
    listing = (
        spark.read.format("binaryFile")
        .options(**source.reader_options)
        .load(source.load_path)
        .select(F.col("_metadata.file_path").alias("file_uri"))
    )
    tasks = max(
        4 * spark.sparkContext.defaultParallelism,
        listing.rdd.getNumPartitions() // FILES_PER_TASK,
    )
    return listing.coalesce(tasks)


def kept_by_key(headers: DataFrame, options: VcfOptions) -> DataFrame:
    """Selected samples of each distinct header."""
    named = headers.where("sample_ids IS NOT NULL").groupBy("header_key")
    distinct = named.agg(F.first("sample_ids").alias("sample_ids"))
    return distinct.select("header_key", F.expr(kept_samples("sample_ids", options)).alias("kept"))
