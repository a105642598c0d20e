"""From the topics to the warehouse: one stream for all four topics."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from playledger.operators.entities import without_known
from playledger.operators.messages import (
    accepted,
    all_rows,
    decode,
    parse_records,
    rejected,
)
from playledger.schemas import TOPICS
from playledger.sources.scratch import drop_folder, held
from playledger.sources.warehouse import REJECTS_TABLE, FolderWarehouse, JdbcWarehouse
from playledger.streaming.batches import batch_tag
from playledger.streaming.redelivery import Redelivery

#: Name under which the per-batch record counts appear in ``query.lastProgress``.
METRICS = "records"
#: The same for the records without their key.
REJECTS_METRICS = "rejects"
#: Records of a dimension in a batch, beyond which their keys are not broadcast: held files are compressed, so that Spark takes them for fewer.
MANY_RECORDS = 250_000


def new_rows(rows: DataFrame, key: str, known: DataFrame, many: bool = False) -> DataFrame:
    """One dimension row for each key that is not stored yet.

    Of several rows with one key the greatest wins, so that the pick is the same on a replay; NULLs
    count as least. The choice is made map-side first, so copies collapse before the shuffle.
    """
    rest = F.struct(*[c for c in rows.columns if c != key])
    single = rows.groupBy(key).agg(F.max(rest).alias("rest")).select(key, "rest.*")
    return without_known(single, known, key, many)


def dispatch(
    records: DataFrame,
    warehouse: FolderWarehouse | JdbcWarehouse,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    unique_dims: bool = True,
    keep_rejects: bool = True,
    compact_every: int = 0,
    redelivery: Redelivery | None = None,
) -> StreamingQuery:
    """Start the stream that parses topic records and appends them to their tables.

    Within a batch the dimensions are written before the plays; nothing waits, as the recaps join
    at query time. Topics without records in the batch are not written. ``unique_dims`` keeps one
    row per key, since a key published twice would count its plays twice. ``keep_rejects`` sends
    records without their key to the table ``rejects``. With both off every parsed row is appended
    as it is. ``compact_every`` merges the stored batches of a folder warehouse before each batch
    whose number it divides, in the thread that writes, so that no write runs beside it. ``redelivery``: plays are
    screened and staged, and its ``settle`` appends each of them once.

    The parsed records of a batch are held as files beside the checkpoint until its tables are written, so that no task
    has to keep its records in memory, however many a batch or a file has.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if compact_every and batch_id and batch_id % compact_every == 0:
            for table in (*[t.table for t in TOPICS.values()], REJECTS_TABLE):
                warehouse.compact(batch.sparkSession, table)
        folder = f"{checkpoint}/parsed"
        try:
            parsed = held(batch, folder)
            screen = redelivery and (lambda rows, tag: redelivery.screen(rows, batch_id, tag))
            _write_batch(parsed, batch_tag(batch, batch_id), warehouse, unique_dims, keep_rejects, screen)
        finally:
            drop_folder(batch.sparkSession, folder)

    # Parsed ahead of the counts, once for both.
    parsed = parse_records(decode(records).filter(F.col("topic").isin(*TOPICS)))
    if "origin" in parsed.columns:  # of use for rejects only
        parsed = parsed.withColumn("origin", F.when(F.col("json_value").isNotNull(), F.col("origin")))
    of_topic = {name: F.col("topic") == name for name in TOPICS}
    counts = [F.count_if(own).alias(name) for name, own in of_topic.items()]
    rejects = [F.count_if(own & F.col("json_value").isNotNull()).alias(name) for name, own in of_topic.items()]
    query = (
        parsed.observe(METRICS, *counts)
        .observe(REJECTS_METRICS, *rejects)
        .writeStream.queryName("dispatch")
        .foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return query.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def _write_batch(
    parsed: DataFrame,
    tag: str,
    warehouse: FolderWarehouse | JdbcWarehouse,
    unique_dims: bool,
    keep_rejects: bool,
    screen: Callable[[DataFrame, str], DataFrame] | None = None,
) -> None:
    spark = parsed.sparkSession
    # At most four rows; also the check for an empty batch.
    counts = parsed.groupBy("topic").agg(
        F.count("*").alias("n_records"), F.count("json_value").alias("n_rejects")
    )
    found = {row["topic"]: row for row in counts.collect()}
    rows_of = accepted if keep_rejects else all_rows
    rejects = [rejected(parsed)] if keep_rejects and any(row["n_rejects"] for row in found.values()) else []
    for topic in TOPICS.values():
        if topic.name not in found:
            continue
        rows = rows_of(parsed, topic.name)
        if unique_dims and not topic.is_fact:
            known = warehouse.known_keys(spark, topic.table, tag)
            rows = new_rows(rows, topic.key, known, found[topic.name]["n_records"] > MANY_RECORDS)
        if topic.is_fact and screen:
            rejects.append(screen(rows, tag))
        else:
            warehouse.append(rows, topic.table, tag)
    if rejects:
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rejects)
        warehouse.append(every, REJECTS_TABLE, tag)
