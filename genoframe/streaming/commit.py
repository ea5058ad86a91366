"""Micro-batches into a folder, each once, whatever fails in between.

A batch is written to a hidden staging folder and becomes visible by one rename to
``batch=<id>``. The name is the proof that it is there: a batch that runs again, after
a failure anywhere, finds it and writes nothing. Renaming a folder is one step on HDFS
and local disks; object stores copy file by file, so there a table format is needed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

STAGING = "_staging"
BATCH = "batch"


def _located(spark: SparkSession, path: str):
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def committed(spark: SparkSession, folder: str, batch_id: int) -> bool:
    """Whether the batch is in the folder."""
    path, fs = _located(spark, f"{folder}/{BATCH}={batch_id}")
    return fs.exists(path)


def commit_batch(rows: DataFrame, batch_id: int, folder: str, stateful: bool = False) -> bool:
    """Write the rows as this batch; False if the folder has it already.

    What earlier attempts left in staging is removed. ``stateful`` rows come out of a
    query with state: they are computed even if the batch is known, since the state of
    the batch has to be made again where only its commit was lost.
    """
    spark = rows.sparkSession
    if committed(spark, folder, batch_id):
        if stateful:
            rows.write.format("noop").mode("overwrite").save()
        return False
    staged = f"{folder}/{STAGING}/{batch_id}-{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    source, fs = _located(spark, staged)
    target, _ = _located(spark, f"{folder}/{BATCH}={batch_id}")
    # Renaming onto a folder would move into it: another writer's batch stays as it is.
    renamed = not fs.exists(target) and fs.rename(source, target)
    if not renamed and not fs.exists(target):
        raise OSError(f"{staged} could not be renamed to {target.toString()}")
    base, _ = _located(spark, f"{folder}/{STAGING}")
    for left in fs.listStatus(base):
        if left.getPath().getName().startswith(f"{batch_id}-"):
            fs.delete(left.getPath(), True)
    return renamed


def read_committed(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All committed rows with the number of their ``batch``; none without a folder."""
    whole = StructType([*schema.fields, StructField(BATCH, LongType())])
    path, fs = _located(spark, folder)
    if not fs.exists(path) or not any(
        status.getPath().getName().startswith(f"{BATCH}=") for status in fs.listStatus(path)
    ):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(folder)


def read_committed_stream(spark: SparkSession, folder: str, schema: StructType, **options: object) -> DataFrame:
    """The same as a stream, without the number of the batch."""
    path, fs = _located(spark, folder)
    fs.mkdirs(path)
    whole = StructType([*schema.fields, StructField(BATCH, LongType())])
    return spark.readStream.schema(whole).options(**options).parquet(folder).drop(BATCH)
