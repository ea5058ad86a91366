"""Running counts of a stream: a stateful aggregation whose changes are kept by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructField, StructType

from genoframe.streaming.commit import BATCH, commit_batch, read_committed

COUNT = "count"


def count_stream(stream: DataFrame, folder: str, by: tuple[str, ...] = ("file_name",)) -> DataStreamWriter:
    """Stream writer that keeps the number of rows per group of ``by`` up to date.

    The counts are in the state of the query; each batch adds the groups that it changed
    to ``folder``, once. The state has a row per group. Start the writer with the trigger
    and checkpoint location of your choice; ``latest_counts`` reads the result, also
    while the query runs.
    """
    counts = stream.groupBy(*by).agg(F.count("*").alias(COUNT))

    def commit(changed: DataFrame, batch_id: int) -> None:
        commit_batch(changed, batch_id, folder, stateful=True)

    return counts.writeStream.outputMode("update").foreachBatch(commit)


def latest_counts(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Counts as of the last committed batch; ``schema`` is that of the ``by`` columns.

    A group's newest batch has its count, so one aggregation over the changes finds it.
    """
    whole = StructType([*schema.fields, *spark.range(0).agg(F.count("*").alias(COUNT)).schema])
    changes = read_committed(spark, folder, StructType([StructField(f.name, f.dataType) for f in whole]))
    return changes.groupBy(*schema.names).agg(F.max_by(COUNT, BATCH).alias(COUNT))
