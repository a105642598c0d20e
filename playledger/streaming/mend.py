"""Rejected records, mended by hand or by a job, back into the warehouse."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from playledger.operators.messages import accepted, parse_records
from playledger.schemas import TOPICS
from playledger.sources.warehouse import MENDED_TABLE, REJECTS_TABLE, FolderWarehouse
from playledger.streaming.dispatch import new_rows


def open_rejects(spark: SparkSession, warehouse: FolderWarehouse) -> DataFrame:
    """Rejects that have not been mended yet: ``topic, json_value, origin``, each origin once.

    One that was read by two runs of a stream has the same origin. Rejects without an origin are late plays, which cannot be mended.
    """
    rejects = warehouse.batches(spark, REJECTS_TABLE).filter("origin IS NOT NULL").drop("batch").distinct()
    return rejects.join(warehouse.read(spark, MENDED_TABLE, missing_ok=True), ["topic", "origin"], "left_anti")


def mend(spark: SparkSession, warehouse: FolderWarehouse, mended: DataFrame, run: str) -> DataFrame:
    """Takes in mended records, ``origin, json_value``, each origin once, and gives those that still lack their key.

    Whichever run brings an origin first has it; a later one with the same origin is passed over, and so is an origin that was
    never rejected. Of several texts for one origin in a run the greatest counts. ``run`` names the run: given again, it replaces what it wrote, so a
    run that failed half way is simply repeated. The origins count as taken in last, after all rows. Two runs must not overlap in time.
    """
    rejects = warehouse.batches(spark, REJECTS_TABLE).filter("origin IS NOT NULL").select("topic", "origin").distinct()
    taken = warehouse.batches(spark, MENDED_TABLE).filter(F.col("batch") != run).select("topic", "origin")
    texts = mended.groupBy("origin").agg(F.max("json_value").alias("json_value"))
    records = rejects.join(taken, ["topic", "origin"], "left_anti").join(texts, "origin")
    parsed = parse_records(records).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for topic in TOPICS.values():
            rows = accepted(parsed, topic.name)
            if not topic.is_fact:
                rows = new_rows(rows, topic.key, warehouse.known_keys(spark, topic.table, run))
            warehouse.append(rows, topic.table, run)
        warehouse.append(parsed.filter("json_value IS NULL").select("topic", "origin"), MENDED_TABLE, run)
    finally:
        parsed.unpersist()
    return open_rejects(spark, warehouse)
