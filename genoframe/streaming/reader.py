"""Streaming reader and per-batch processing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from genoframe.options import VcfOptions
from genoframe.plans.header_join import join_headers_once, look_up_headers
from genoframe.plans.parse import record_lines, vcf_columns
from genoframe.plans.rejects import observed_records
from genoframe.plans.shared import remove, shared_path
from genoframe.schema import vcf_schema
from genoframe.sources.headers import headers_from_sample_ids, sample_ids
from genoframe.sources.heads import can_open
from genoframe.sources.lines import vcf_lines_stream
from genoframe.sources.paths import VcfPath, resolve
from genoframe.streaming.commit import commit_batch, committed, read_committed_stream

# Options that belong to Spark's streaming file source.
STREAM_OPTIONS = (
    "maxFilesPerTrigger",
    "maxBytesPerTrigger",
    "latestFirst",
    "maxFileAge",
    "cleanSource",
    "sourceArchiveDir",
)


def _split_options(options: dict[str, object]) -> tuple[dict[str, object], dict[str, object]]:
    names = {name.lower(): name for name in STREAM_OPTIONS}
    source = {names[n.lower()]: v for n, v in options.items() if n.lower() in names}
    reader = {n: v for n, v in options.items() if n.lower() not in names}
    return source, reader


def _spread(lines: DataFrame, source_options: dict[str, object]) -> DataFrame:
    """The lines over all cores, if a micro-batch has fewer files than there are.

    A gzip file is one task, which would parse all of its lines; unparsed they are
    dealt out at little cost. Each line goes by its text, so a task that runs again
    deals the same.
    """
    files = str(source_options.get("maxFilesPerTrigger", ""))
    cores = lines.sparkSession.sparkContext.defaultParallelism
    if not files.isdigit() or int(files) >= cores:
        return lines
    return lines.repartition(cores, F.xxhash64("value"))


def _existing(spark: SparkSession, path: str) -> VcfPath:
    source = resolve(spark, path)
    if source is None:
        # An empty stream would never see the files that appear later.
        raise FileNotFoundError(path)
    return source


def read_vcf_stream(
    spark: SparkSession,
    path: str,
    relay: str | None = None,
    observation: str | None = None,
    **options: object,
) -> DataFrame:
    """Stream the records of a file or directory, each exactly once.

    Takes the options of ``read_vcf`` and those of Spark's file stream source,
    such as ``maxFilesPerTrigger``. Files must be complete when they appear. Each
    task reads the heads of its files.

    Storage that Python workers cannot open needs a ``relay``, a folder of its own:
    ``relay_vcf`` fills it, here once with all that is there, and the stream reads it.
    Keep a ``relay_vcf`` query running to stream what appears later. Without a relay
    such storage is refused; ``foreach_vcf_batch`` and ``write_vcf_once`` read it too.

    ``observation`` names the numbers of records and of dropped lines by reason in the
    progress of the query, see ``RejectListener``; a relay has dropped them before.
    """
    source_options, reader_options = _split_options(options)
    parsed = VcfOptions.parse(reader_options)
    source = _existing(spark, path)
    if relay is not None:
        relay_vcf(spark, path, relay, **options).awaitTermination()
        return read_committed_stream(spark, relay, vcf_schema())
    problem = can_open(source.root)
    if problem:
        raise ValueError(
            f"workers cannot open {path}, name a relay or use foreach_vcf_batch: {problem}"
        )
    lines = _spread(vcf_lines_stream(spark, source, source_options), source_options)
    records = record_lines(lines) if observation is None else observed_records(lines, observation)
    return vcf_columns(look_up_headers(records, parsed), parsed)


def relay_vcf(
    spark: SparkSession,
    path: str,
    relay: str,
    trigger: dict[str, object] | None = None,
    **options: object,
) -> StreamingQuery:
    """Start the query that puts the parsed records of a stream into the relay folder.

    Heads are found in the micro-batch by Spark itself, stored, and joined to its
    lines, with no Python in any task. Every batch enters the folder once; progress is
    in the folder too, so the query can be started again at any time. By default it
    ends with what is there; ``trigger`` takes those of ``DataStreamWriter.trigger``.
    """
    writer = write_vcf_once(spark, path, relay, scan_headers=True, **options)
    started = writer.option("checkpointLocation", f"{relay}/_checkpoint")
    return started.trigger(**(trigger or {"availableNow": True})).start()


def write_vcf_once(
    spark: SparkSession,
    path: str,
    folder: str,
    process: Callable[[DataFrame, int], DataFrame] | None = None,
    scan_headers: bool = False,
    **options: object,
) -> DataStreamWriter:
    """Stream writer that puts the parsed records into ``folder``, each batch once.

    ``process`` may turn a batch into other rows first; it runs again if the batch does.
    A batch that is in the folder is skipped before it is parsed. Start the writer with
    one checkpoint location per folder; ``read_committed`` reads the rows.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        rows = batch if process is None else process(batch, batch_id)
        commit_batch(rows, batch_id, folder)

    def is_done(batch_id: int) -> bool:
        return committed(spark, folder, batch_id)

    return foreach_vcf_batch(spark, path, commit, scan_headers, is_done, **options)


def foreach_vcf_batch(
    spark: SparkSession,
    path: str,
    process: Callable[[DataFrame, int], None],
    scan_headers: bool = False,
    is_done: Callable[[int], bool] | None = None,
    **options: object,
) -> DataStreamWriter:
    """Stream writer that hands every micro-batch to ``process`` as parsed rows.

    Where workers can open the files, they read the heads. Elsewhere, or with
    ``scan_headers``, the headers are found in the micro-batch, which holds whole
    files, and kept in the shared folder until ``process`` returns. Batches that
    ``is_done`` knows are left out. Start it with the trigger and checkpoint location
    of your choice.
    """
    source_options, reader_options = _split_options(options)
    parsed = VcfOptions.parse(reader_options)
    source = _existing(spark, path)
    lines = vcf_lines_stream(spark, source, source_options)
    opens = not scan_headers and can_open(source.root) is None

    def parse_batch(batch: DataFrame, batch_id: int) -> None:
        if is_done is not None and is_done(batch_id):
            return
        if opens:
            staged = look_up_headers(record_lines(batch), parsed)
            process(vcf_columns(staged, parsed), batch_id)
            return
        folder = shared_path(batch.sparkSession, f"batch-{batch_id}")
        try:
            headers = headers_from_sample_ids(sample_ids(batch), folder)
            staged = join_headers_once(record_lines(batch), headers, parsed)
            process(vcf_columns(staged, parsed), batch_id)
        finally:
            remove(batch.sparkSession, folder)

    return lines.writeStream.foreachBatch(parse_batch)
