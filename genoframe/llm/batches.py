"""Memory of the Python workers: size of Arrow batches, and what tasks leave behind."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# Fixed value: Spark's default, the sign that a session has not chosen.
UNCHOSEN = "67108864b"
BATCH_BYTES = str(8 << 20)


def small_batches(spark: SparkSession) -> None:
    """Let batches of texts hold 8 MB where the session has not chosen a size.

    A batch stands in the JVM and in the worker, before and after the operator, for
    every core of an executor: at Spark's default that is most of a small executor's
    memory outside its heap. Batches only group rows, so no result depends on it.
    """
    if spark.conf.get(SETTING, UNCHOSEN) == UNCHOSEN:
        spark.conf.set(SETTING, BATCH_BYTES)


def returning_memory(task: Task) -> Task:
    """The task, giving freed memory back to the system at its end.

    Python workers live on between tasks. What numpy and Arrow have freed stays in
    their pools otherwise, beside the memory that the next operator needs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run
