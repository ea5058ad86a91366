"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, ``spark.checkpoint.dir``.

    A local session, where driver and tasks are one machine, gets a temporary
    folder if none is set. Any other master must name one: a folder made here
    would exist on the driver alone.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        # local, local[8], local[4,2]; local-cluster[...] runs executors of its own.
        local = context.master == "local" or context.master.startswith("local[")
        if not configured and not local:
            raise ValueError(
                f"set spark.checkpoint.dir to a folder that all executors of {context.master} see"
            )
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="genoframe-"))
    return configured or context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Delete a path when the driver's JVM ends."""
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(located)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path that ``shared_path`` gave."""
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(located, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each action on a DataFrame made inside when it ends.

    They would stay until the driver happens to collect its garbage. For steps that are
    stored and whose plans do not run again: a DataFrame that is to be returned is made
    outside.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
