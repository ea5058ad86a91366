"""Why lines are dropped, and how many, in the pass that parses the rest."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from genoframe.functions import fields
from genoframe.plans.parse import body_lines

RECORDS = "records"


def with_reason(body: DataFrame) -> DataFrame:
    """Trimmed body lines with ``reason``: NULL for a record, else the first of
    ``few_fields``, ``position`` and ``quality`` that is wrong."""
    return body.withColumn("reason", F.expr(fields.reject_reason("value")))


def reject_reasons(lines: DataFrame) -> DataFrame:
    """The body lines that are dropped as malformed, with the reason of each."""
    return with_reason(body_lines(lines)).where("reason IS NOT NULL")


def _metrics() -> list[Column]:
    reason = F.col("reason")
    dropped = [F.count_if(reason == name).alias(name) for name in fields.REASONS]
    return [F.count_if(reason.isNull()).alias(RECORDS), *dropped]


def observed_records(lines: DataFrame, observation: Observation | str) -> DataFrame:
    """Record lines, as ``record_lines`` gives them, counted on the way.

    An ``Observation`` has the numbers of records and of dropped lines by reason after
    the first action on a batch; a name puts them into the progress of a stream, where
    ``RejectListener`` sums them up. Lines are read once either way. Filters on what is
    parsed run behind the count, which has to see every line.
    """
    counted = with_reason(body_lines(lines)).observe(observation, *_metrics())
    return counted.where("reason IS NULL").drop("reason")


class RejectListener(StreamingQueryListener):
    """Sums up what streams observed under a name, over all their batches.

    Add it with ``spark.streams.addListener``. A batch that runs again after a failure
    counts once, as the query reports it.
    """

    def __init__(self, name: str):
        self.name = name
        self._lock = Lock()
        self._batches: dict[tuple[str, int], dict[str, int]] = {}

    def totals(self) -> dict[str, int]:
        with self._lock:
            batches = list(self._batches.values())
        return {name: sum(b[name] for b in batches) for name in (RECORDS, *fields.REASONS)}

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            key = (str(event.progress.id), event.progress.batchId)
            with self._lock:
                self._batches[key] = row.asDict()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
