"""Counts of each batch as a table that outlives the process."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent

from playledger.schemas import TOPICS
from playledger.streaming.dispatch import METRICS, REJECTS_METRICS

_SCHEMA = "query STRING, batch_id BIGINT, topic STRING, n_records BIGINT, n_rejects BIGINT, started_at STRING, seconds DOUBLE"


class BatchMetrics(StreamingQueryListener):
    """Appends the observed counts of every ``dispatch`` batch to Parquet at ``path``: a row for each topic with records.

    A batch has a partition of its own, which a replay replaces. The listener runs beside the stream; ``wait`` returns
    once all events of a query have been written. Add it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        found = [progress.observedMetrics.get(name) for name in (METRICS, REJECTS_METRICS)]
        if None in found:
            return
        counts, rejects = (row.asDict() for row in found)
        seconds = progress.batchDuration / 1000
        rows = [
            (str(progress.id), progress.batchId, name, counts[name], rejects[name], progress.timestamp, seconds)
            for name in TOPICS
            if counts.get(name)
        ]
        if rows:  # at most four
            (
                self.spark.createDataFrame(rows, _SCHEMA)
                .coalesce(1)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("query", "batch_id")
                .parquet(self.path)
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, run: str, seconds: float = 60.0) -> bool:
        """Whether all batches of the run (``query.runId``) have been written, waiting for it if need be."""
        return self._end_of(str(run)).wait(seconds)

    def read(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(self.path)


def totals(metrics: DataFrame) -> DataFrame:
    """Records and rejects by topic, over all batches."""
    return metrics.groupBy("topic").agg(F.sum("n_records").alias("n_records"), F.sum("n_rejects").alias("n_rejects"))
