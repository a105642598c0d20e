"""The test tables seen as plays, songs, albums, artists, payloads and replies.

Two stars share their dimensions: one over ``lineitem`` (volume, dates at midnight) and one over
``events`` (times within the day, song ids inside JSON). Everything is derived by Spark from whole
tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playledger.functions import format_played_at
from playledger.schemas import LINK_FIELD, SONG_TOPIC
from playledger.sources import Entities
from playledger.star import Star

#: Dates for which the tables hold plays.
LINEITEM_WEEK = "1998-07-08"
LINEITEM_END = "2001-12-01"
EVENTS_WEEK = "2024-01-10"
EVENTS_END = "2024-01-31"
EMPTY_WEEK = "2024-02-14"
#: A date in the middle of the plays of ``lineitem``.
LINEITEM_PAST = "1996-05-08"
#: Days from before the first play of ``lineitem`` to after the last.
LINEITEM_DAYS = ("1980-01-01", "1995-02-28", LINEITEM_PAST, LINEITEM_WEEK, LINEITEM_END, "2030-01-01")
FETCHED_AT = "2024-01-01 00:00:00"


#: Given, so that opening a table does not start a job that reads its footer.
_SCHEMAS = {
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    song = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_name").alias("title"),
        (F.col("p_size") * 10_000).alias("duration_ms"),
    )
    album = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("album_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("image_url"),
    )
    artist = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("name")
    )
    return song, album, artist


def lineitem_star(spark: SparkSession, sf_dir: str) -> Star:
    fact = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("song_id"),
        F.col("l_orderkey").alias("album_id"),
        F.col("l_suppkey").alias("artist_id"),
        F.col("l_shipdate").alias("played_at"),
    )
    return Star(fact, *_dims(spark, sf_dir))


def _event_song() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def events_star(spark: SparkSession, sf_dir: str) -> Star:
    fact = table(spark, sf_dir, "events").select(
        _event_song().alias("song_id"),
        F.col("user_id").alias("album_id"),
        (_event_song() % 10).alias("artist_id"),
        F.col("ts").alias("played_at"),
    )
    return Star(fact, *_dims(spark, sf_dir))


def song_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the details of each part arrive, as songs: by size, over the weeks of the events and one after."""
    hours = F.make_dt_interval(hours=F.col("p_size") * 16)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("song_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + hours).alias("arrived_at")
    )


def star_of_text_ids(star: Star) -> Star:
    """The star with text ids, as plays and payloads carry them."""
    return Star(
        star.fact,
        *[star.dim(k).withColumn(k, F.col(k).cast("string"))
          for k in ("song_id", "album_id", "artist_id")],
    )


def history_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a history page with its play; that of a ``click`` also has a play of the next
    song. Tracks of ``error`` events name no artist."""

    def item(song: Column) -> Column:
        artist = F.array(F.struct((song % 10).cast("string").alias("id")))
        none = F.array().cast("array<struct<id:string>>")
        return F.struct(
            format_played_at(F.col("ts")).alias("played_at"),
            F.struct(
                song.cast("string").alias("id"),
                F.struct(F.col("user_id").cast("string").alias("id")).alias("album"),
                F.when(F.col("event_type") == "error", none).otherwise(artist).alias("artists"),
            ).alias("track"),
        )

    one, next_one = item(F.col("song")), item((F.col("song") + 1) % 100)
    items = F.when(F.col("event_type") == "click", F.array(one, next_one)).otherwise(F.array(one))
    events = table(spark, sf_dir, "events").select("ts", "user_id", "event_type",
                                                   _event_song().alias("song"))
    return events.select(items.alias("items"))


def _url(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"https://music.example/{kind}/"), F.col(key).cast("string"))


def _json(**fields: Column) -> Column:
    return F.to_json(
        F.struct(*[value.alias(name) for name, value in fields.items()]),
        {"ignoreNullFields": "false"},
    )


def entities(spark: SparkSession, sf_dir: str) -> Entities:
    """Parts, orders and suppliers as raw song, album and artist payloads.

    Songs lack the preview, have a null one, or have one. Albums know their release date by year,
    month or day; low-priority ones have no image.
    """
    size = F.col("p_size")
    song = dict(
        name=F.col("p_name"),
        disc_number=size % 3 + 1,
        duration_ms=size * 10_000,
        explicit=size % 2 == 0,
        external_urls=F.struct(_url("song", "p_partkey").alias(LINK_FIELD)),
        popularity=size,
    )
    previews = (
        F.when(size % 3 == 0, _json(**song))
        .when(size % 3 == 1, _json(**song, preview_url=F.lit(None).cast("string")))
        .otherwise(_json(**song, preview_url=_url("preview", "p_partkey")))
    )
    day = F.left(F.col("o_orderdate").cast("string"), F.lit(10))
    release = (
        F.when(F.col("o_orderstatus") == "F", F.left(day, F.lit(4)))
        .when(F.col("o_orderstatus") == "O", F.left(day, F.lit(7)))
        .otherwise(day)
    )
    image = F.struct(_url("image", "o_orderstatus").alias("url"))
    images = F.when(
        F.col("o_orderpriority") == "5-LOW", F.array().cast("array<struct<url:string>>")
    ).otherwise(F.array(image, F.struct(_url("small", "o_orderstatus").alias("url"))))
    album = _json(
        name=F.col("o_orderpriority"),
        total_tracks=(F.col("o_custkey") % 20 + 1).cast("int"),
        release_date=release,
        external_urls=F.struct(_url("album", "o_orderkey").alias(LINK_FIELD)),
        images=images,
        label=F.concat(F.lit("label "), F.col("o_orderpriority")),
        popularity=(F.col("o_custkey") % 101).cast("int"),
    )
    artist = _json(
        name=F.col("s_name"),
        external_urls=F.struct(_url("artist", "s_suppkey").alias(LINK_FIELD)),
        followers=F.struct((F.col("s_suppkey") * 7).cast("int").alias("total")),
        images=F.array(F.struct(_url("portrait", "s_nationkey").alias("url"))),
        popularity=F.col("s_nationkey"),
    )

    def landing(name: str, key: str, kind: str, payload: Column) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.col(key).cast("string").alias(f"{kind}_id"),
            payload.alias("payload"),
            F.lit(FETCHED_AT).cast("timestamp_ntz").alias("fetched_at"),
        )

    return Entities(
        landing("part", "p_partkey", "song", previews),
        landing("orders", "o_orderkey", "album", album),
        landing("supplier", "s_suppkey", "artist", artist),
    )


def known_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star of a warehouse that lacks some details: those of one kind of part, of one order
    status, and of one half of the nations."""
    star = lineitem_star(spark, sf_dir)
    song = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO")
    album = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    artist = table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") >= 12)
    return Star(
        star.fact,
        song.select(F.col("p_partkey").alias("song_id")),
        album.select(F.col("o_orderkey").alias("album_id")),
        artist.select(F.col("s_suppkey").alias("artist_id")),
    )


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song records made of events, each kind of event damaged in its own way."""
    song_id = F.concat(F.lit('{"song_id":"'), F.col("event_id").cast("string"), F.lit('"'))
    value = F.col("value").cast("decimal(18,2)").cast("string")
    large = (F.col("event_id") + 3_000_000_000).cast("string")
    text = (
        F.when(F.col("event_type") == "view", F.concat(song_id, F.lit(',"title":"cut off')))
        .when(F.col("event_type") == "signup", F.concat(song_id, F.lit("}")))
        .when(
            F.col("event_type") == "click",
            F.concat(song_id, F.lit(',"duration_ms":"7","extra":[1],"popularity":'),
                     F.col("user_id").cast("string"), F.lit("}")),
        )
        .when(
            F.col("event_type") == "error",
            F.concat(F.lit('{"title":'), F.col("user_id").cast("string"),
                     F.lit(',"popularity":'), value, F.lit("}")),
        )
        .otherwise(
            F.concat(song_id, F.lit(',"title":["t"],"explicit":"true","duration_ms":'), large,
                     F.lit("}"))
        )
    )
    return table(spark, sf_dir, "events").select(
        text.cast("binary").alias("value"), F.lit(SONG_TOPIC).alias("topic")
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as service replies: ``conv_id, turn, reply``.

    Even turns are complete and fenced; odd turns of the assistant have one key only; other odd
    turns are plain text.
    """
    text = F.col("text")
    whole = _json(
        opening_statement=text,
        weekly_recap=F.concat(F.lit("week "), F.col("turn").cast("string")),
        mood_recap=F.col("role"),
        recommendations=F.concat(text, F.lit(" & more")),
        closing_statement=F.lit("bye"),
    )
    reply = (
        F.when(F.col("turn") % 2 == 0, F.concat(F.lit("```json\n"), whole, F.lit("\n```")))
        .when(F.col("role") == "assistant", _json(mood_recap=text))
        .otherwise(text)
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", reply.alias("reply"))


def report_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reply per report date, made of all turns of one role; that for the first date lacks a
    key: ``as_of, reply``."""
    turns = table(spark, sf_dir, "conversations").groupBy("role").agg(
        F.count("*").cast("string").alias("turns"),
        F.min("text").alias("first_text"),
        F.max("text").alias("last_text"),
    )
    as_of = (
        F.when(F.col("role") == "system", F.lit(EVENTS_WEEK))
        .when(F.col("role") == "user", F.lit(EVENTS_END))
        .otherwise(F.lit(EMPTY_WEEK))
    )
    some = dict(
        opening_statement=F.concat(F.lit("turns: "), F.col("turns")),
        weekly_recap=F.col("first_text"),
        mood_recap=F.col("role"),
        recommendations=F.col("last_text"),
    )
    text = F.when(F.col("role") == "system", _json(**some)).otherwise(
        _json(**some, closing_statement=F.lit("'bye' & <thanks>"))
    )
    fenced = F.concat(F.lit("```json"), text, F.lit("```"))
    return turns.select(as_of.cast("date").alias("as_of"), fenced.alias("reply"))
