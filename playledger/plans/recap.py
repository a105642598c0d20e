"""The four recaps over the warehouse star."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from playledger.functions import moment, monday_of
from playledger.functions.clock import AsOf
from playledger.operators.intervals import PAIR, last_plays_at
from playledger.operators.listening import (
    in_week,
    in_weeks,
    last_play_by,
    last_play_by_dates,
    minutes_by,
    played_by,
    plays_by,
    resolve,
    top_k,
)
from playledger.schemas import SECTION_NAMES
from playledger.star import DIM_KEYS, Dimensions, Star

# Output columns that a section lacks are NULL in the combined recap table.
_COLUMNS = {
    "song_name": "string",
    "album": "string",
    "artist": "string",
    "album_art": "string",
    "total_minute_listened": "bigint",
    "last_played": "timestamp_ntz",
    "days_ago": "int",
}


def _week_plays(star: Star, as_of: AsOf) -> DataFrame:
    return plays_by(in_week(star.fact, as_of), *DIM_KEYS)


def top_songs(star: Star, as_of: AsOf = None, k: int = 10) -> DataFrame:
    """Songs with the most minutes listened in the week."""
    names = ("song_name", "album", "artist", "album_art")
    plays = resolve(_week_plays(star, as_of), star, *DIM_KEYS)
    return top_k(minutes_by(plays, *names), k, "total_minute_listened", *names)


def top_albums(star: Star, as_of: AsOf = None, k: int = 5) -> DataFrame:
    """Albums with the most minutes listened in the week."""
    names = ("album", "artist", "album_art")
    plays = resolve(_week_plays(star, as_of), star, *DIM_KEYS)
    return top_k(minutes_by(plays, *names), k, "total_minute_listened", *names)


def top_artists(star: Star, as_of: AsOf = None, k: int = 5) -> DataFrame:
    """Artists with the most minutes listened in the week; albums need not be known.

    It starts from the same counts as the songs and albums, so that in the suite they are made once.
    """
    plays = resolve(_by_artist(_week_plays(star, as_of)), star, "song_id", "artist_id")
    return top_k(minutes_by(plays, "artist"), k, "total_minute_listened", "artist")


def _by_artist(plays: DataFrame, *more: str) -> DataFrame:
    """Counts of plays per id combination, without the album."""
    return plays.groupBy(*more, "song_id", "artist_id").agg(F.sum("plays").alias("plays"))


def forgotten_songs(star: Star, as_of: AsOf = None, k: int = 10) -> DataFrame:
    """Songs whose last play lies furthest back, over all plays up to the day of ``as_of``; artists
    need not be known."""
    names = ("song_name", "album_art")
    keys = ("song_id", "album_id")
    plays = resolve(last_play_by(played_by(star.fact, as_of), *keys), star, *keys)
    last = plays.groupBy(*names).agg(F.max("last_played").alias("last_played"))
    days_ago = F.datediff(moment(as_of).cast("date"), F.col("last_played").cast("date"))
    return top_k(last.withColumn("days_ago", days_ago), k, "days_ago", *names)


@dataclass(frozen=True)
class Section:
    """One recap of the suite: its query, its size, and the order of its rows."""

    number: int
    k: int
    query: Callable[..., DataFrame]
    measure: str
    keys: tuple[str, ...]

    @property
    def name(self) -> str:
        return SECTION_NAMES[self.number]


SECTIONS = (
    Section(1, 10, top_songs, "total_minute_listened",
            ("song_name", "album", "artist", "album_art")),
    Section(2, 5, top_albums, "total_minute_listened", ("album", "artist", "album_art")),
    Section(3, 5, top_artists, "total_minute_listened", ("artist",)),
    Section(4, 10, forgotten_songs, "days_ago", ("song_name", "album_art")),
)


def recaps(star: Star, as_of: AsOf = None) -> dict[str, DataFrame]:
    """The four recaps under their names, in order; nothing runs until one is read."""
    return {s.name: s.query(star, as_of, s.k) for s in SECTIONS}


def _ranking(section: Section, per: str) -> Column:
    window = Window.partitionBy(per).orderBy(
        F.desc_nulls_last(section.measure), *[F.asc_nulls_first(c) for c in section.keys]
    )
    return F.row_number().over(window)


def _long(section: Section, ranked: DataFrame) -> DataFrame:
    """Ranked rows of a section in the common columns."""
    columns = [
        (F.col(name) if name in ranked.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in _COLUMNS.items()
    ]
    number, name = F.lit(section.number), F.lit(section.name)
    return ranked.select(
        "as_of", number.alias("section_no"), name.alias("section"), "rank", *columns
    )


def recap_table(star: Star, as_of: AsOf = None) -> DataFrame:
    """All four recaps as one table with ``as_of, section_no, section, rank``, in one job.

    Ranks are numbered after the limit, over at most k rows.
    """

    def rows(section: Section) -> DataFrame:
        recap = section.query(star, as_of, section.k)
        recap = recap.withColumn("as_of", moment(as_of).cast("date"))
        return _long(section, recap.withColumn("rank", _ranking(section, "as_of")))

    return reduce(DataFrame.unionByName, [rows(section) for section in SECTIONS])


def report_days(spark: SparkSession, as_of: Sequence[AsOf]) -> DataFrame:
    """The different days of the dates given: ``as_of``."""
    if not as_of:
        raise ValueError("give at least one date")
    days = F.array(*[moment(date).cast("date") for date in as_of])
    return spark.range(1).select(F.explode(F.array_distinct(days)).alias("as_of"))


def recap_tables(star: Star, as_of: Sequence[AsOf]) -> DataFrame:
    """The recap tables of several dates, each as ``recap_table`` gives it.

    A date that is given twice counts once, whether as text, date or time. The plays are scanned for
    all dates together, not once per date. The top rows of each week or day are taken by a ranking
    window; Spark cuts its input to k rows per week and task before the shuffle.
    """
    dates = list(as_of)
    wanted = report_days(star.fact.sparkSession, dates).withColumn("week", monday_of(F.col("as_of")))
    counts = plays_by(in_weeks(star.fact, dates), "week", *DIM_KEYS)

    def of_weeks(section: Section, counts: DataFrame, *keys: str) -> DataFrame:
        plays = resolve(counts, star, *keys)
        minutes = minutes_by(plays, "week", *section.keys)
        ranked = minutes.withColumn("rank", _ranking(section, "week"))
        return _long(section, wanted.join(ranked.filter(F.col("rank") <= section.k), "week"))

    songs, albums, artists, forgotten = SECTIONS
    unheard = _unheard(last_play_by_dates(star.fact, dates, *PAIR), star)
    return reduce(
        DataFrame.unionByName,
        [
            of_weeks(songs, counts, *DIM_KEYS),
            of_weeks(albums, counts, *DIM_KEYS),
            of_weeks(artists, _by_artist(counts, "week"), "song_id", "artist_id"),
            _long(forgotten, unheard),
        ],
    )


def _unheard(pairs: DataFrame, star: Star | Dimensions) -> DataFrame:
    """Songs whose last play lies furthest back, ranked for each day of ``as_of``."""
    section = SECTIONS[3]
    last = resolve(pairs, star, *PAIR).groupBy("as_of", *section.keys)
    days_ago = F.datediff("as_of", F.col("last_played").cast("date"))
    ranked = last.agg(F.max("last_played").alias("last_played")).withColumn("days_ago", days_ago)
    return ranked.withColumn("rank", _ranking(section, "as_of")).filter(F.col("rank") <= section.k)


def forgotten_songs_at(intervals: DataFrame, dims: Star | Dimensions, as_of: Sequence[AsOf]) -> DataFrame:
    """``forgotten_songs`` for several days, past ones too, out of the table of intervals: no play is read."""
    return _long(SECTIONS[3], _unheard(last_plays_at(intervals, as_of), dims))
