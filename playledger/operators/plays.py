"""Operators over plays: from payload pages to fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from playledger.functions import epoch_ms, first_field, parse_played_at


def explode_plays(pages: DataFrame) -> DataFrame:
    """One row per play of each history page; a page without items gives no rows.

    The artist is the first one of the track, NULL if the track names none.
    """
    item = F.col("item")
    return pages.select(F.explode("items").alias("item")).select(
        item["played_at"].alias("played_at"),
        item["track"]["id"].alias("song_id"),
        item["track"]["album"]["id"].alias("album_id"),
        first_field(item["track"]["artists"], "id").alias("artist_id"),
    )


def with_event_id(plays: DataFrame) -> DataFrame:
    """Plays with a random 128-bit id, as 32 hex digits.

    Separate from the explode because a random column keeps filters from being pushed below it.
    """
    return plays.withColumn("id", F.replace(F.uuid(), F.lit("-"), F.lit("")))


def plays_after(plays: DataFrame, after_ms: int | Column) -> DataFrame:
    """Plays strictly newer than the cursor (epoch milliseconds)."""
    played_at = F.col("played_at")
    if isinstance(plays.schema["played_at"].dataType, StringType):
        played_at = parse_played_at(played_at)
    return plays.filter(played_at > epoch_ms(after_ms))


def fact_rows(plays: DataFrame) -> DataFrame:
    """The four columns of a play that the warehouse keeps."""
    return plays.select("song_id", "album_id", "artist_id", "played_at")


def batch_summary(plays: DataFrame) -> DataFrame:
    """One row: number of plays, and whether there were none."""
    return plays.agg(F.count("*").alias("n_plays")).withColumn(
        "no_new_data", F.col("n_plays") == 0
    )
