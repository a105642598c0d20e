"""Helpers that both streaming jobs share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def batch_tag(batch: DataFrame, batch_id: int) -> str:
    """Name of a micro-batch: unique across queries, and the same when the batch is replayed.

    The query id comes from the checkpoint, so a query on a new checkpoint does not overwrite what
    an earlier one wrote under the same batch number.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}.{batch_id}"


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the query, and stop it on interrupt or failure."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        query.stop()
