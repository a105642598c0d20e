import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from playledger.operators.entities import (
    enrich,
    flatten_album,
    flatten_artist,
    flatten_song,
    new_keys,
    without_known,
)
from playledger.operators.messages import decode, parse_topic, to_messages
from playledger.operators.plays import (
    batch_summary,
    explode_plays,
    fact_rows,
    plays_after,
    with_event_id,
)
from playledger.plans import route
from playledger.schemas import HISTORY_PAYLOAD, LINK_FIELD, SONG_TOPIC, TOPICS
from playledger.sources import Entities
from playledger.star import Star
from tests.util import bag, plan, rows


def play(at, song, album="a1", artists=("r1",)):
    return {
        "played_at": at,
        "track": {"id": song, "album": {"id": album}, "artists": [{"id": r} for r in artists]},
    }


def pages(spark, *items):
    return spark.createDataFrame([{"items": list(i)} for i in items], HISTORY_PAYLOAD)


T1, T2 = "2024-07-01T00:00:00.001Z", "2024-07-01T00:00:00.002Z"


def test_explode_plays(spark):
    df = explode_plays(
        pages(spark, [play(T1, "s1"), play(T2, "s2", "a2", ("r2", "r3"))], [],
              [play(T1, "s3", artists=())])
    )
    assert df.columns == ["played_at", "song_id", "album_id", "artist_id"]
    assert bag(df) == {
        (T1, "s1", "a1", "r1"): 1,
        (T2, "s2", "a2", "r2"): 1,
        (T1, "s3", "a1", None): 1,
    }


def test_event_ids_are_hex_and_distinct(spark):
    ids = [r.id for r in with_event_id(spark.range(500).withColumnRenamed("id", "n")).collect()]
    assert len(set(ids)) == 500
    assert all(len(i) == 32 and int(i, 16) >= 0 for i in ids)


def test_fact_rows_drop_the_id(spark):
    plays = with_event_id(explode_plays(pages(spark, [play(T1, "s1")])))
    assert fact_rows(plays).columns == ["song_id", "album_id", "artist_id", "played_at"]


@pytest.mark.parametrize("as_text", [True, False])
def test_plays_after_is_strict(spark, zone, as_text):
    plays = explode_plays(pages(spark, [play(T1, "s1"), play(T2, "s2"), play("bad", "s3")]))
    if not as_text:
        text = F.left("played_at", F.lit(23))
        plays = plays.withColumn("played_at", text.try_cast("timestamp_ntz"))
    assert [r.song_id for r in plays_after(plays, 1_719_792_000_001).collect()] == ["s2"]
    assert plays_after(plays, F.lit(1_719_792_000_000)).count() == 2


def test_batch_summary(spark):
    some = explode_plays(pages(spark, [play(T1, "s1"), play(T2, "s2")]))
    none = explode_plays(pages(spark, []))
    assert rows(batch_summary(some)) == [(2, False)]
    assert rows(batch_summary(none)) == [(0, True)]


SONG = {
    "name": "n", "disc_number": 1, "duration_ms": 5, "explicit": True,
    "external_urls": {LINK_FIELD: "u"}, "popularity": 9, "unused": [1, {"x": 2}],
}


@pytest.mark.parametrize(
    "extra, wanted",
    [({}, "No preview available"), ({"preview_url": None}, None), ({"preview_url": "p"}, "p")],
)
def test_flatten_song(spark, extra, wanted):
    raw = spark.createDataFrame([("s1", json.dumps(SONG | extra))], "song_id string, payload string")
    assert rows(flatten_song(raw)) == [("s1", "n", 1, 5, True, "u", wanted, 9)]


def test_flatten_of_text_that_is_no_payload(spark):
    raw = spark.createDataFrame([("s1", "{bad")], "song_id string, payload string")
    assert rows(flatten_song(raw)) == [("s1",) + (None,) * 7]


@pytest.mark.parametrize("images, wanted", [([], None), ([{"url": "i"}, {"url": "j"}], "i")])
def test_flatten_album_and_artist(spark, images, wanted):
    album = {
        "name": "n", "total_tracks": 3, "release_date": "1999", "label": "l", "popularity": 4,
        "external_urls": {LINK_FIELD: "u"}, "images": images,
    }
    artist = {
        "name": "n", "external_urls": {LINK_FIELD: "u"}, "followers": {"total": 7},
        "images": images, "popularity": 4,
    }
    raw = spark.createDataFrame([("a1", json.dumps(album))], "album_id string, payload string")
    assert rows(flatten_album(raw)) == [("a1", "n", 3, "1999", "u", wanted, "l", 4)]
    raw = spark.createDataFrame([("r1", json.dumps(artist))], "artist_id string, payload string")
    assert rows(flatten_artist(raw)) == [("r1", "n", "u", 7, wanted, 4)]


def test_new_keys_are_distinct_unknown_and_not_null(spark):
    plays = spark.createDataFrame([("s1",), ("s1",), ("s2",), (None,), ("s3",)], "song_id string")
    dim = spark.createDataFrame([("s2",), ("s2",), ("s9",), (None,)], "song_id string")
    assert bag(new_keys(plays, dim, "song_id")) == {("s1",): 1, ("s3",): 1}


def test_a_small_persisted_batch_is_broadcast_to_the_known_keys(spark, tmp_path):
    plays = spark.createDataFrame([("s1",)], "song_id string").persist()
    plays.count()
    spark.range(2_000_000).selectExpr("repeat(cast(id as string), 3) AS song_id").write.parquet(str(tmp_path / "known"))
    text = plan(without_known(plays, spark.read.parquet(str(tmp_path / "known")), "song_id"))
    plays.unpersist()
    assert "BroadcastHashJoin" in next(line for line in text.splitlines() if "LeftSemi" in line)


def test_without_broadcast_the_known_keys_are_shuffled_once(spark, no_broadcast):
    plays = spark.createDataFrame([("s1",)], "song_id string")
    known = spark.createDataFrame([("s1",), ("s2",)], "song_id string")
    text = plan(without_known(plays, known, "song_id"))
    assert "BroadcastHashJoin" not in text and "LeftAnti" in text and "LeftSemi" in text
    # Rows, known keys, and the rows again for the semi-join.
    assert text.count("Exchange hashpartitioning") <= 3


RAW = "song_id string, payload string, fetched_at timestamp_ntz"
OLD, NEW = datetime(2024, 7, 1), datetime(2024, 7, 2)


def test_enrich_takes_the_copy_fetched_last(spark):
    keys = spark.createDataFrame([("s1",), ("s3",), ("s4",), ("s5",)], "song_id string")
    raw = spark.createDataFrame(
        [("s1", "z old", OLD), ("s1", "a new", NEW), ("s1", "zz", None), ("s2", "z", OLD),
         ("s4", "x", OLD), ("s4", "y", OLD), ("s5", "p", None), ("s5", "q", None)],
        RAW,
    )
    assert bag(enrich(keys, raw, "song_id")) == {("s1", "a new"): 1, ("s4", "y"): 1, ("s5", "q"): 1}


def test_enrich_joins_before_it_merges(spark, no_broadcast):
    keys = spark.createDataFrame([("s1",)], "song_id string")
    lines = plan(enrich(keys, spark.createDataFrame([], RAW), "song_id")).splitlines()
    join = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    assert any("max(" in line for line in lines[:join])
    assert not any("max(" in line for line in lines[join:])


def test_messages_keep_nulls_and_unicode(spark):
    df = spark.createDataFrame([("é☃", None)], "song_id string, title string")
    (value, topic), = rows(to_messages(df, SONG_TOPIC))
    assert topic == SONG_TOPIC
    assert json.loads(bytes(value).decode("utf-8")) == {"song_id": "é☃", "title": None}


def test_route(spark):
    plays = explode_plays(
        pages(spark, [play(T1, "s1"), play(T2, "s1"), play(T2, "s2", "a2", ("r2",))],
              [play(T2, "s4", "a1", ())])
    )

    def known(key, *ids):
        return spark.createDataFrame([(i,) for i in ids], f"{key} string")

    star = Star(plays, known("song_id", "s2"), known("album_id", "a1", "a2"),
                known("artist_id", "zz"))

    def raw(key, *ids):
        return spark.createDataFrame(
            [(i, json.dumps({"name": f"name {i}"}), OLD) for i in ids],
            f"{key} string, payload string, fetched_at timestamp_ntz",
        )

    entities = Entities(raw("song_id", "s1", "s2", "s3"), raw("album_id", "a1", "a2"),
                        raw("artist_id", "r1"))
    records = route(plays, star, entities)
    found = {
        topic: bag(parse_topic(decode(records), topic).select(spec.message.names[0]))
        for topic, spec in TOPICS.items()
    }
    assert found == {
        "song_topic": {("s1",): 1},
        "album_topic": {},
        "artist_topic": {("r1",): 1},
        "item_topic": {("s1",): 2, ("s2",): 1, ("s4",): 1},
    }
