"""When each song and album pair was played last, as of any day: intervals of days in which an answer holds.

The table has a partition for each span of days ("bucket") with the intervals that reach into it. Buckets of a level are twice as long as those of
the level below, and an interval is in the lowest level whose buckets are not shorter than it: in two buckets at most, however long it is. The answer for a day
is the one interval of a pair that holds the day, found in the bucket of the day alone, one for each level, so a past date reads neither the plays nor other days.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from playledger.functions import moment
from playledger.functions.clock import AsOf
from playledger.schemas import FACT_TABLE, TABLES

PAIR = ("song_id", "album_id")
#: Days of a bucket of the lowest level. Shorter ones make more levels; longer ones read more for a day.
BUCKET_DAYS = 64


def last_play_intervals(fact: DataFrame) -> DataFrame:
    """``song_id, album_id, from_day, until_day, last_played``: from the day of each last play to the day before the next.

    An open end is null. A pair with a play without a time has an answer, without a last play, from the beginning.
    Plays are first cut down to one per pair and day, in each task; a window has at most the days of one pair.
    """
    day = F.col("played_at").cast("date").alias("from_day")
    daily = fact.groupBy(*PAIR, day).agg(F.max("played_at").alias("last_played"))
    following = F.lead("from_day").over(Window.partitionBy(*PAIR).orderBy(F.asc_nulls_first("from_day")))
    return daily.select(*PAIR, "from_day", following.alias("until_day"), "last_played")


def _bucket(day: Column, level: Column | None = None) -> Column:
    length = BUCKET_DAYS if level is None else BUCKET_DAYS * F.pow(F.lit(2), level)
    return F.floor(F.unix_date(day) / length).cast("int")


def write_intervals(fact: DataFrame, path: str) -> None:
    """Writes the intervals of all plays to ``path``, partitioned by level and bucket, in place of what is there.

    Intervals with an open end reach to the last bucket that has plays, those with an open beginning to the first; days beyond are answered there.
    """
    intervals = last_play_intervals(fact)
    ends = fact.agg(F.min("played_at").cast("date").alias("first"), F.max("played_at").cast("date").alias("last"))
    # One row.
    first, last = (F.lit(date(1970, 1, 1) if day is None else day) for day in ends.first())
    begin = F.coalesce("from_day", first)
    end = F.greatest(begin, F.coalesce(F.date_sub("until_day", 1), last))
    level = F.greatest(F.lit(0), F.ceil(F.log2((F.datediff(end, begin) + 1) / BUCKET_DAYS))).cast("int")
    spread = intervals.withColumns({"level": level, "begin": begin, "end": end})
    buckets = F.sequence(*[_bucket(F.col(day), F.col("level")) for day in ("begin", "end")])
    spread = spread.withColumn("bucket", F.explode(buckets)).drop("begin", "end")
    spread.hint("rebalance", "level", "bucket").write.mode("overwrite").partitionBy("level", "bucket").parquet(path)


def read_intervals(fact_schema: T.StructType | None, path: str, spark) -> DataFrame:
    """The written intervals. ``fact_schema``: of the plays, if their ids are not text."""
    kinds = {f.name: f.dataType for f in fact_schema or TABLES[FACT_TABLE].row}
    fields = [T.StructField(k, kinds[k]) for k in PAIR]
    fields += [T.StructField(n, T.DateType()) for n in ("from_day", "until_day")]
    fields += [T.StructField("last_played", T.TimestampNTZType())]
    fields += [T.StructField(n, T.IntegerType()) for n in ("level", "bucket")]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def last_plays_at(intervals: DataFrame, as_of: Sequence[AsOf]) -> DataFrame:
    """Latest play per pair as it was at the end of each of several days: ``song_id, album_id, as_of, last_played``.

    The buckets of the days are found first, which is a handful of rows, so that only these partitions are read.
    """
    spark = intervals.sparkSession
    days = F.array_distinct(F.array(*[moment(day).cast("date") for day in as_of]))
    # At most one row per level, and one per level and date.
    ends = intervals.groupBy("level").agg(F.min("bucket").alias("least"), F.max("bucket").alias("most")).collect()
    wanted = spark.range(1).select(F.explode(days).alias("as_of"))
    levels = spark.createDataFrame(ends, "level INT, least INT, most INT")
    own = F.greatest("least", F.least("most", _bucket(F.col("as_of"), F.col("level"))))
    found = [tuple(r) for r in levels.crossJoin(wanted).select("as_of", "level", own).collect()]
    holds = F.col("from_day").isNull() | (F.col("from_day") <= F.col("as_of"))
    holds &= F.col("until_day").isNull() | (F.col("as_of") < F.col("until_day"))
    asked = spark.createDataFrame(found, "as_of DATE, level INT, bucket INT")
    of_level = {r["level"]: {bucket for _, level, bucket in found if level == r["level"]} for r in ends}
    read = [(F.col("level") == level) & F.col("bucket").isin(*buckets) for level, buckets in of_level.items()]
    parts = intervals.filter(reduce(operator.or_, read, F.lit(False)))
    return parts.join(asked, ["level", "bucket"]).filter(holds).select(*PAIR, "as_of", "last_played")
