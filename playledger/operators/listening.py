"""Operators of the recap queries: week filter, pre-aggregation, star joins, minutes, top-k.

Aggregates are taken per id *before* the dimension joins. The sums and maxima of the recaps allow
it exactly, and it means that the plays are shuffled once, as map-side partial aggregates: a song
with a third of all plays is one row per task, and the joins see one row per id combination.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from playledger.functions import moment, monday_of, week_bounds, week_of
from playledger.functions.clock import AsOf
from playledger.star import DIM_KEYS, Dimensions, Star

#: Partition column of file-based fact tables.
PLAY_DATE = "play_date"
#: Column of a play's time in epoch milliseconds, where the time is also kept as text.
PLAY_MS = "played_ms"
#: Columns that only counted plays have: the Monday of their week, and how many plays a row stands for.
WEEK, PLAYS = "week", "plays"

# What a recap needs of each dimension.
_NAMES = {
    "song_id": {"song_name": "title", "duration_ms": "duration_ms"},
    "album_id": {"album": "title", "album_art": "image_url"},
    "artist_id": {"artist": "name"},
}


def in_week(fact: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Plays inside the recap window of ``as_of``.

    Both bounds fold to literals and reach the scan. A fact table partitioned by play date is also
    pruned to the days of the window. Counted plays (``count_plays``) know their week.
    """
    return fact.filter(_window(fact, as_of))


def _window(fact: DataFrame, as_of: AsOf) -> Column:
    start, end = week_bounds(as_of)
    played_at = F.col("played_at")
    window = (played_at >= start) & (played_at < end)
    if WEEK in fact.columns:
        window = F.col(WEEK) == monday_of(moment(as_of).cast("date"))
    if PLAY_DATE in fact.columns:
        window &= F.col(PLAY_DATE).between(start.cast("date"), end.cast("date"))
    return window


def in_weeks(fact: DataFrame, as_of: Sequence[AsOf]) -> DataFrame:
    """Plays inside the recap windows of several dates, with the Monday of their ``week``.

    One scan for all dates. Its filter is the union of the windows, so that of a fact table
    partitioned by play date only the days of the weeks asked for are read.
    """
    plays = fact.filter(reduce(Column.__or__, [_window(fact, date) for date in as_of]))
    return plays if WEEK in fact.columns else plays.withColumn(WEEK, week_of(F.col("played_at")))


def count_plays(fact: DataFrame) -> DataFrame:
    """Plays counted by day, week and ids: ``play_date, week, <ids>, plays, played_at``, the last being that of the last play.

    Such rows can stand for the plays in every recap, and counts of parts of the plays may simply be put together:
    sums and maxima do the rest. The day is needed besides the week, as a recap of a past date only counts plays up to it.
    """
    day = F.col("played_at").cast("date").alias(PLAY_DATE)
    counts = fact.groupBy(day, week_of(F.col("played_at")).alias(WEEK), *DIM_KEYS)
    return counts.agg(F.count("*").alias(PLAYS), F.max("played_at").alias("played_at"))


def played_by(fact: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Plays up to the end of the day of ``as_of``, and those without a time."""
    return _until(fact, day_after(as_of))


def day_after(as_of: AsOf = None) -> Column:
    """The midnight that ends the day of ``as_of``."""
    return F.date_add(moment(as_of).cast("date"), 1).cast("timestamp_ntz")


def _until(fact: DataFrame, end: Column) -> DataFrame:
    before = F.col("played_at").isNull() | (F.col("played_at") < end)
    if PLAY_DATE in fact.columns:
        before &= F.col(PLAY_DATE).isNull() | (F.col(PLAY_DATE) < end.cast("date"))
    return fact.filter(before)


def last_play_by_dates(fact: DataFrame, as_of: Sequence[AsOf], *keys: str) -> DataFrame:
    """Latest play per id combination as it was at the end of each of several days:
    ``<keys>, as_of, last_played``, without the days before the first play. A combination with a play
    without a time counts on all days, if need be without a last play. One scan for all."""
    ends = [day_after(date) for date in as_of]
    last = F.greatest(*ends) if len(ends) > 1 else ends[0]
    played_at = F.col("played_at")
    lasts = [F.max(F.when(played_at < end, played_at)).alias(f"last_{i}") for i, end in enumerate(ends)]
    by_day = F.array_distinct(
        F.array(
            *[
                F.struct(moment(d).cast("date").alias("as_of"), F.col(f"last_{i}").alias("last_played"))
                for i, d in enumerate(as_of)
            ]
        )
    )
    timeless = F.bool_or(played_at.isNull()).alias("timeless")
    found = _until(fact, last).groupBy(*keys).agg(timeless, *lasts)
    rows = found.select(*keys, "timeless", F.inline(by_day))
    return rows.filter(F.col("timeless") | F.col("last_played").isNotNull()).drop("timeless")


def plays_by(fact: DataFrame, *keys: str) -> DataFrame:
    """Number of plays per id combination."""
    number = F.sum(PLAYS) if PLAYS in fact.columns else F.count("*")
    return fact.groupBy(*keys).agg(number.alias(PLAYS))


def last_play_by(fact: DataFrame, *keys: str) -> DataFrame:
    """Latest play per id combination."""
    return fact.groupBy(*keys).agg(F.max("played_at").alias("last_played"))


def resolve(rows: DataFrame, star: Star | Dimensions, *keys: str) -> DataFrame:
    """Rows joined with the recap columns of the dimensions of ``keys``.

    Inner equi-joins: rows with a NULL or unknown id are dropped. No side is hinted; statistics and
    adaptive execution choose the strategy, and split skewed partitions of the large joins.
    """

    def named(key: str) -> DataFrame:
        columns = [F.col(source).alias(name) for name, source in _NAMES[key].items()]
        return star.dim(key).select(key, *columns)

    return reduce(lambda left, key: left.join(named(key), key, "inner"), keys, rows)


def listened_ms() -> Column:
    """Total listening time of pre-aggregated plays; songs of unknown length do not count."""
    return F.sum(F.col("plays") * F.col("duration_ms").cast("bigint"))


def whole_minutes(ms: Column) -> Column:
    """Milliseconds to whole minutes, rounded down, in exact integer arithmetic."""
    minute = F.lit(60_000)
    return F.call_function("div", ms - F.pmod(ms, minute), minute)


def minutes_by(plays: DataFrame, *names: str) -> DataFrame:
    """Whole minutes listened per name combination; the total is rounded, not each play."""
    total = plays.groupBy(*names).agg(listened_ms().alias("ms"))
    return total.select(*names, whole_minutes(F.col("ms")).alias("total_minute_listened"))


def top_k(rows: DataFrame, k: int, measure: str, *keys: str) -> DataFrame:
    """First ``k`` rows by descending measure, NULLs last; ties go by the keys, ascending."""
    return rows.orderBy(F.desc_nulls_last(measure), *[F.asc_nulls_first(c) for c in keys]).limit(k)


def unresolved(fact: DataFrame, star: Star) -> DataFrame:
    """Ids of the plays that no dimension row resolves: ``dimension, key, plays``.

    These plays are not lost: the recaps join at query time, and so count them as soon as the
    dimension row has arrived. The plays are scanned once, and counted before they become a row for each dimension.
    """

    ids = F.array(*[_named_key(key) for key in DIM_KEYS])
    counts = plays_by(fact, *DIM_KEYS).select(PLAYS, F.inline(ids))
    plays = counts.groupBy("dimension", "key").agg(F.sum(PLAYS).alias(PLAYS))
    known = [star.dim(key).select(_named_key(key).alias("k")).select("k.*") for key in DIM_KEYS]
    return plays.join(reduce(DataFrame.unionByName, known), ["dimension", "key"], "left_anti")


def _named_key(key: str) -> Column:
    return F.struct(
        F.lit(key.removesuffix("_id")).alias("dimension"), F.col(key).cast("string").alias("key")
    )
