"""Exact duplicates by content sort.

Spark samples splitters and deals normalised texts out by range, an external sort
by all their bytes puts equals next to each other, and whole neighbouring texts are
compared. The key ends with the id, so a text with a third of all rows spreads over
as many ranges as it needs; what a range boundary cuts apart is joined again from
one summary row per boundary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.llm.batches import returning_memory, small_batches
from genoframe.plans.shared import shared_folder, shared_path

# Splitters reach the driver, so they carry the head of a text and its digest only.
HEAD_BYTES = 32
BYTES_PER_RANGE = 32 << 20
# Ranges grow beyond that many, so that splitters and boundaries stay bounded: the
# driver samples a hundred keys of some 100 bytes for each. The sort of a range spills.
MAX_RANGES = 8192

# Working columns, named so that columns of the input do not clash with them.
NORM, HEAD, DIGEST = "_exact_norm", "_exact_head", "_exact_sha256"
# Whole rows go as one struct, so that their columns cannot clash at all.
ROW = "_exact_row"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    # A lone space stays as it is and need not be matched.
    return F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def _sorted_ranges(docs: DataFrame, column: str) -> DataFrame:
    """The column, doc_id or a struct with it and the text, with normalised text and digest, dealt out and sorted by content.

    Splitters are of head, digest and id. A range is sorted by these with the whole
    bytes before the id, so texts of one head stand in the order of their digests, and
    equal ones together whatever their digests. Rows are shuffled with their text once;
    it is normalised again in front of the sort.
    """
    spark = docs.sparkSession
    small_batches(spark)
    inside = f"{ROW}." if column == ROW else ""
    names = [column] if inside else [column, "text"]
    text, doc_id = F.col(f"{inside}text"), F.col(f"{inside}doc_id")
    keyed = docs.select(*names, normalised(text).alias(NORM)).select(
        *names,
        F.substring(F.encode(NORM, "UTF-8"), 1, HEAD_BYTES).alias(HEAD),
        F.sha2(NORM, 256).alias(DIGEST),
    )
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    wanted = min(-(-size // BYTES_PER_RANGE), MAX_RANGES)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    splitters = [F.col(HEAD), F.col(DIGEST), doc_id.asc_nulls_last()]
    dealt = keyed.repartitionByRange(ranges, *splitters)
    whole = dealt.select(column, normalised(text).alias(NORM), HEAD, DIGEST)
    ordered = whole.sortWithinPartitions(HEAD, DIGEST, NORM, doc_id.asc_nulls_last())
    return ordered.drop(HEAD)


def _run_starts(texts: pa.Array, before: str | None) -> np.ndarray:
    """Places at which another text starts than stands before; ``before`` is the
    last text of the batch before, None for the first batch."""
    changes = pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
    first = before is None or texts[0].as_py() != before
    return np.flatnonzero(np.concatenate([[first], changes]))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with smallest id and size of their run of equal texts.

    Only the ids of the open run are kept, 8 bytes each and no more than the
    range has rows.
    """
    ids: list[pa.Array] = []
    text = digest = None
    runs = 0

    def closed(at_edge: bool) -> pa.RecordBatch:
        members = pa.concat_arrays(ids)
        n = len(members)
        leads = np.zeros(n, dtype=bool)
        leads[0] = True
        columns = {
            "doc_id": members,
            "text_sha256": pa.repeat(pa.scalar(digest, pa.string()), n),
            "run_min": pa.repeat(pa.scalar(pc.min(members).as_py(), pa.int64()), n),
            "run_size": pa.repeat(pa.scalar(n, pa.int64()), n),
            "leads": pa.array(leads),
            "at_edge": pa.repeat(pa.scalar(at_edge), n),
        }
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch[NORM]
        starts = _run_starts(texts, text)
        bounds = sorted({0, batch.num_rows, *starts.tolist()})
        new, out = set(starts.tolist()), []
        for start, end in zip(bounds, bounds[1:]):
            if start in new and ids:
                # The first run of a range may continue the range before it.
                out.append(closed(at_edge=runs == 0))
                runs, ids = runs + 1, []
            ids.append(batch["doc_id"][start:end])
            digest = batch[DIGEST][start].as_py()
        text = texts[-1].as_py()
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
    if ids:
        yield closed(at_edge=True)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are; null equals empty. Of equal
    texts the row with the smallest id is kept, one row only if that id is
    repeated; a null id is the smallest only if all are null. No documents give
    no rows; other columns are not read.
    """
    shared_folder(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = (
        "doc_id bigint, text_sha256 string, run_min bigint, run_size bigint, "
        "leads boolean, at_edge boolean"
    )
    runs = _sorted_ranges(rows, "doc_id").mapInArrow(returning_memory(_runs), schema)
    runs = runs.withColumn("at", F.spark_partition_id()).checkpoint()
    # At most two runs per range touch a boundary, so this table is small.
    cut = (
        runs.where("at_edge AND leads")
        .groupBy("text_sha256")
        .agg(
            F.min("run_min").alias("all_min"),
            F.sum("run_size").alias("all_size"),
            # The ranges are in order: the first run of a text has its smallest id.
            F.min("at").alias("range"),
            F.count("*").alias("n_runs"),
        )
        .where("n_runs > 1")
        .drop("n_runs")
    )
    joined = runs.join(F.broadcast(cut), "text_sha256", "left")
    return joined.select(
        "doc_id",
        F.coalesce("all_min", "run_min").alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        (F.col("leads") & F.coalesce(F.col("at") == F.col("range"), F.lit(True))).alias("kept"),
        "text_sha256",
    )


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each run in a range, without its normalised text."""
    text = None
    for batch in batches:
        if batch.num_rows:
            starts = _run_starts(batch[NORM], text)
            text = batch[NORM][-1].as_py()
            names = [name for name in batch.schema.names if name != NORM]
            yield batch.select(names).take(pa.array(starts))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with all columns.

    Same rules as ``exact_duplicates``. Whole rows go through the one sort; the
    first row of each run is written to the shared folder, and a run that goes on
    in the next range loses its later first rows when that is read.
    """
    spark = docs.sparkSession
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias(ROW)
    ordered = _sorted_ranges(docs.select(row), ROW)
    schema = T.StructType([f for f in ordered.schema.fields if f.name != NORM])
    leads = ordered.mapInArrow(returning_memory(_leads), schema).withColumn("_exact_range", F.spark_partition_id())
    folder = shared_path(spark, "exact")
    leads.write.parquet(folder)
    stored = spark.read.schema(leads.schema).parquet(folder)
    cut = (
        stored.groupBy(DIGEST)
        .agg(F.min("_exact_range").alias("_exact_first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col(DIGEST).alias("_exact_again"), "_exact_first")
    )
    # A text has two first rows only where a range ends inside it: one per range.
    later = (F.col(DIGEST) == F.col("_exact_again")) & (
        F.col("_exact_range") > F.col("_exact_first")
    )
    kept = stored.join(F.broadcast(cut), later, "left_anti")
    return kept.select(f"{ROW}.*")
