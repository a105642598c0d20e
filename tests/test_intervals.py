"""Last plays as of any day, from intervals; payload fields read from one parse."""

import json
from datetime import date, datetime, timedelta

import pytest

from playledger.operators.entities import flatten_album, flatten_song
from playledger.operators.intervals import BUCKET_DAYS, last_play_intervals, last_plays_at, read_intervals, write_intervals
from playledger.operators.listening import last_play_by_dates
from playledger.plans import forgotten_songs, forgotten_songs_at
from playledger.star import Star
from tests.util import bag, plan, rows

FACT = "song_id string, album_id string, artist_id string, played_at timestamp_ntz"
T0 = datetime(2024, 1, 31, 23, 59, 59)


def fact(spark, *days, more=()):
    plays = [(f"s{i % 3}", "a", "r", T0 + timedelta(days=d, seconds=i % 2)) for i, d in enumerate(days)]
    return spark.createDataFrame([*plays, *more], FACT)


DAYS = [0, 0, 0, 1, 5, 5, 63, 64, 65, 400, 401, 900, 2, 2, 2, 700]
MORE = [("s1", "b", "r", None), ("s1", "b", "r", T0), (None, "a", "r", T0), ("s2", None, "r", None)]
DATES = [str((T0 + timedelta(days=d)).date()) for d in (-900, -1, 0, 1, 2, 4, 5, 6, 62, 63, 64, 399, 400, 899, 900, 901, 5000)]


def test_every_day_is_answered_as_by_the_plays(spark, tmp_path):
    plays = fact(spark, *DAYS, more=MORE)
    write_intervals(plays, f"{tmp_path}/i")
    found = last_plays_at(read_intervals(None, f"{tmp_path}/i", spark), [*DATES, DATES[0]])
    assert bag(found) == bag(last_play_by_dates(plays, DATES, "song_id", "album_id"))


def test_intervals_of_a_pair_follow_each_other(spark):
    found = last_play_intervals(fact(spark, 0, 0, 0, 3, more=[("s0", "a", "r", T0 + timedelta(days=1))]))
    mine = sorted(r[2:4] for r in found.collect() if r["song_id"] == "s0")
    day = lambda d: T0.date() + timedelta(days=d)
    # The last one is a second past midnight.
    assert mine == [(day(0), day(1)), (day(1), day(4)), (day(4), None)]
    assert all(r["last_played"].date() == r["from_day"] for r in found.collect())


def test_a_day_reads_one_bucket(spark, tmp_path):
    write_intervals(fact(spark, *range(0, 20 * BUCKET_DAYS, 7)), f"{tmp_path}/i")
    table = read_intervals(None, f"{tmp_path}/i", spark)
    assert table.select("bucket").distinct().count() >= 20
    found = last_plays_at(table, ["2025-01-01"])
    assert "= 313" in plan(found).split("PartitionFilters: [")[1].split("]")[0]
    # One row per pair and bucket besides the changes of the bucket.
    assert table.filter("bucket = 313").count() <= 3 * (BUCKET_DAYS // 7 + 2)


def test_a_long_interval_is_written_twice_at_most(spark, tmp_path):
    days = [*range(0, 40 * BUCKET_DAYS, 17), 0, 3, 700, 1400, 2500]
    plays = spark.createDataFrame([(f"s{i}", "a", "r", T0 + timedelta(days=d)) for i, d in enumerate(days)] + [("x", "a", "r", None)], FACT)
    write_intervals(plays, f"{tmp_path}/i")
    table = read_intervals(None, f"{tmp_path}/i", spark)
    assert table.count() <= 2 * last_play_intervals(plays).count()
    found = last_plays_at(table, DATES)
    assert bag(found) == bag(last_play_by_dates(plays, DATES, "song_id", "album_id"))


def test_tables_without_plays_or_times(spark, tmp_path):
    for i, rest in enumerate(([], [("s1", "a", "r", None)])):
        plays = spark.createDataFrame(rest, FACT)
        write_intervals(plays, f"{tmp_path}/{i}")
        found = last_plays_at(read_intervals(None, f"{tmp_path}/{i}", spark), ["2024-01-01"])
        assert rows(found) == [("s1", "a", date(2024, 1, 1), None) for _ in rest]


def test_recap_of_past_days_reads_no_play(spark, tmp_path):
    plays = fact(spark, *DAYS, more=MORE)
    plays.write.parquet(f"{tmp_path}/fact_history")
    star = Star(
        spark.read.parquet(f"{tmp_path}/fact_history"),
        spark.createDataFrame([("s0", "Same", 1), ("s1", "Same", 1), ("s2", "Two", 1)], "song_id string, title string, duration_ms int"),
        spark.createDataFrame([("a", "A", "art"), ("b", "B", None)], "album_id string, title string, image_url string"),
        spark.createDataFrame([], "artist_id string, name string"),
    )
    write_intervals(star.fact, f"{tmp_path}/i")
    found = forgotten_songs_at(read_intervals(None, f"{tmp_path}/i", spark), star, DATES)
    assert "fact_history" not in plan(found)
    for day in DATES:
        mine = found.filter(found["as_of"] == day).select("song_name", "album_art", "last_played", "days_ago")
        assert bag(mine) == bag(forgotten_songs(star, day)), day


# --- payloads -----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "given, wanted",
    [("7", None), (7.5, None), (3_000_000_000, None), (7, 7), (True, None), (None, None), ([7], None)],
)
def test_numbers_of_another_type_are_null(spark, given, wanted):
    raw = spark.createDataFrame([("s", json.dumps({"duration_ms": given, "name": "n"}))], "song_id string, payload string")
    assert rows(flatten_song(raw).select("duration_ms", "title")) == [(wanted, "n")]


@pytest.mark.parametrize("given, wanted", [(5, "5"), ("x", "x"), (None, None), (["2"], '["2"]'), ({"a": 1}, '{"a":1}'), (True, "true")])
def test_any_value_counts_as_text(spark, given, wanted):
    raw = spark.createDataFrame([("a", json.dumps({"name": given}))], "album_id string, payload string")
    assert rows(flatten_album(raw).select("title")) == [(wanted,)]


def test_absent_and_null_are_told_apart_by_one_parse(spark, tmp_path):
    texts = ["{}", '{"preview_url":null}', '{"preview_url":"u"}', "[1]", "{bad", None, '{"images":5,"external_urls":"x"}']
    raw = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "song_id string, payload string")
    found = {r["song_id"]: r["preview_url"] for r in flatten_song(raw).collect()}
    none = "No preview available"
    assert found == {"0": none, "1": None, "2": "u", "3": None, "4": None, "5": None, "6": none}
    raw.write.parquet(f"{tmp_path}/raw")
    physical = plan(flatten_song(spark.read.parquet(f"{tmp_path}/raw")))
    assert physical.count("ariantExpressionEvalUtils") + physical.count("arse_json(") == 1, physical
