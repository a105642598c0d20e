"""Plays that are delivered more than once count once.

Two streams. In the batches of ``dispatch`` plays are screened: one that lies further than ``delay`` behind the newest play of earlier
batches is late, as a copy of it may have been forgotten, and goes to the rejects; the others are staged. The second stream reads the
staged plays and drops copies by keyed state that expires with the watermark. No play is late there that was not before: its
watermark only follows plays that were staged before, and is twice as patient. So nothing is dropped unseen.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from playledger.functions import event_time
from playledger.schemas import FACT_TABLE, ITEM_TOPIC, TABLES
from playledger.sources.landing import bounded
from playledger.sources.warehouse import FolderWarehouse, JdbcWarehouse
from playledger.streaming.batches import batch_tag

_CLOCK = "slot INT, batch_id BIGINT, newest TIMESTAMP_NTZ"


@dataclass(frozen=True)
class Redelivery:
    """A shared folder for staged plays, and how long after the newest play a play may still come, for instance ``2 hours``."""

    root: str
    delay: str

    def _newest_before(self, spark: SparkSession, batch_id: int) -> Any:
        """Time of the newest play of all batches before this one; None at the beginning.

        The clock has two places, written in turn, so a batch that runs again finds what it found at first.
        """
        try:
            clock = spark.read.schema(_CLOCK).parquet(f"{self.root}/clock")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        row = clock.filter((F.col("slot") == (batch_id - 1) % 2) & (F.col("batch_id") == batch_id - 1)).first()
        return row["newest"] if row else None

    def screen(self, plays: DataFrame, batch_id: int, tag: str) -> DataFrame:
        """Stages the plays that are on time, and gives the others as rejects: ``topic, json_value``, without an origin.

        Plays without a time cannot be told from copies of older ones, and are rejects, too.
        """
        spark = plays.sparkSession
        newest = self._newest_before(spark, batch_id)
        played_at = F.col("played_at")
        on_time = played_at.isNotNull()
        if newest is not None:
            on_time &= played_at >= F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay}")
        self._write(plays.filter(on_time).withColumn("batch", F.lit(tag)), "plays", "batch")
        clock = plays.agg(F.max(played_at).alias("own")).select(
            F.lit(batch_id % 2).alias("slot"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.greatest("own", F.lit(newest).cast("timestamp_ntz")).alias("newest"),
        )
        self._write(clock.coalesce(1), "clock", "slot")
        value = F.to_json(F.struct(*TABLES[FACT_TABLE].row.names), {"ignoreNullFields": "false"})
        return plays.filter(~on_time).select(F.lit(ITEM_TOPIC).alias("topic"), value.alias("json_value"))

    def _write(self, rows: DataFrame, folder: str, partition: str) -> None:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(f"{self.root}/{folder}")
        )

    def settle(
        self,
        spark: SparkSession,
        warehouse: FolderWarehouse | JdbcWarehouse,
        checkpoint: str,
        trigger: dict[str, Any] | None = None,
        max_files: int | None = None,
    ) -> StreamingQuery:
        """Start the stream that appends each staged play once. ``dispatch`` has to have run before."""
        plays = bounded(spark.readStream.schema(TABLES[FACT_TABLE].row), max_files, None).parquet(f"{self.root}/plays/batch=*")
        timed = plays.withColumn("play_time", event_time(F.col("played_at"))).withWatermark("play_time", _twice(self.delay))
        once = timed.dropDuplicatesWithinWatermark(TABLES[FACT_TABLE].row.names).drop("play_time")

        def write(batch: DataFrame, batch_id: int) -> None:
            warehouse.append(batch, FACT_TABLE, batch_tag(batch, batch_id))

        query = once.writeStream.queryName("settle").foreachBatch(write).outputMode("append")
        query = query.option("checkpointLocation", checkpoint)
        return query.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def _twice(delay: str) -> str:
    number, unit = delay.split()
    return f"{2 * int(number)} {unit}"
