"""Plays whose details come later: a join of two streams that waits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playledger.functions import event_time


def with_arrival(
    plays: DataFrame, arrivals: DataFrame, key: str, wait: str, before: str, lateness: str = "0 seconds"
) -> DataFrame:
    """Plays with ``arrived_at``, the time when the details of their ``key`` arrived, each emitted once.

    ``plays``: a stream with ``played_at``; ``arrivals``: a stream ``<key>, arrived_at`` with one row per key, as ``dispatch`` keeps dimensions.
    A play is emitted as soon as both are there, if the details arrive from ``before`` ahead of it to ``wait`` after it. If they have not
    when the wait is over, it is emitted without a time: it is unresolved. A play without a key or a time has nothing to wait for, but
    is emitted only as the watermark passes; one without a time never is, so keep those apart.

    Both sides have a watermark, ``lateness`` behind the newest time, and the bounds of the condition let Spark forget plays
    after ``wait`` and arrivals after ``before``. What is unresolved is known once both streams have moved past the wait; a side that
    rests can be moved on by a row of a key that nothing has (one without a key does not count). A hot
    key is one state partition's; a play is one row of it while it waits.
    """
    known = arrivals.select(
        F.col(key).alias("arrived_key"), "arrived_at", event_time(F.col("arrived_at")).alias("arrival_time")
    ).withWatermark("arrival_time", lateness)
    waiting = plays.withColumn("play_time", event_time(F.col("played_at"))).withWatermark("play_time", lateness)
    in_time = F.col("arrival_time").between(
        F.col("play_time") - F.expr(f"INTERVAL {before}"), F.col("play_time") + F.expr(f"INTERVAL {wait}")
    )
    joined = waiting.join(known, (F.col(key) == F.col("arrived_key")) & in_time, "left_outer")
    return joined.drop("arrived_key", "arrival_time", "play_time")
