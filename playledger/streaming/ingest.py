"""From history pages to the topics: explode, find new keys, add details, route."""

from __future__ import annotations

from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from playledger.operators.plays import explode_plays
from playledger.plans.routing import route
from playledger.sources.landing import read_entities
from playledger.sources.topics import FolderTopics, KafkaTopics
from playledger.sources.warehouse import FolderWarehouse, JdbcWarehouse
from playledger.streaming.batches import batch_tag


def ingest(
    pages: DataFrame,
    warehouse: FolderWarehouse | JdbcWarehouse,
    entity_root: str,
    topics: FolderTopics | KafkaTopics,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Start the stream that turns history pages, or the plays of ``stream_history``, into topic records.

    Of the warehouse only the dimensions are opened; one that does not exist yet is empty. They and the entity landing tables are read anew for each batch. Pages count as read
    only when their batch is committed, so a failed batch is repeated, not lost.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        plays = (explode_plays(batch) if "items" in batch.columns else batch).persist(StorageLevel.DISK_ONLY)
        try:
            if not plays.count():
                return
            known, entities = warehouse.dimensions(spark), read_entities(spark, entity_root)
            records = route(plays, known, entities)
            topics.append(records, batch_tag(batch, batch_id))
        finally:
            plays.unpersist()

    query = (
        pages.writeStream.queryName("ingest")
        .foreachBatch(publish)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return query.trigger(**(trigger or {"processingTime": "60 seconds"})).start()
