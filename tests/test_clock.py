from datetime import date, datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from playledger.functions import (
    epoch_ms,
    format_played_at,
    moment,
    parse_played_at,
    parse_release_date,
    week_bounds,
    week_of,
)
from playledger.operators.listening import in_week
from tests.util import rows


def python_bounds(day):
    monday = datetime.combine(day - timedelta(days=day.weekday()), datetime.min.time())
    return monday - timedelta(days=1) + timedelta(minutes=1), monday + timedelta(
        days=5, hours=8, minutes=59
    )


def test_week_bounds_of_each_day_of_twelve_years(spark, zone):
    days = spark.sql("SELECT explode(sequence(DATE'2018-01-01', DATE'2030-01-01')) AS day")
    start, end = week_bounds(F.col("day"))
    found = rows(days.select("day", start, end))
    assert len(found) > 4000
    for day, lo, hi in found:
        assert (lo, hi) == python_bounds(day)


def test_week_of_each_hour_agrees_with_the_bounds(spark, zone):
    hours = spark.sql(
        "SELECT explode(sequence(TIMESTAMP_NTZ'2023-12-20 00:00:30', TIMESTAMP_NTZ'2024-04-10 00:00:00', "
        "INTERVAL '30' MINUTE)) AS at"
    )
    edges = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ'2024-06-30 00:00:59.999', TIMESTAMP_NTZ'2024-06-30 00:01:00', "
        "TIMESTAMP_NTZ'2024-07-06 08:58:59.999', TIMESTAMP_NTZ'2024-07-06 08:59:00')) AS at"
    )
    found = rows(hours.unionAll(edges).select("at", week_of(F.col("at"))))
    assert len(found) > 5000
    for at, monday in found:
        day = at.date()
        weeks = {day - timedelta(days=day.weekday() + n) for n in (-7, 0, 7)}
        inside = [w for w in weeks if python_bounds(w)[0] <= at < python_bounds(w)[1]]
        assert inside == ([] if monday is None else [monday])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.datetimes(datetime(1990, 1, 1), datetime(2090, 1, 1)))
def test_week_bounds_of_a_moment(spark, when):
    start, end = week_bounds(when)
    assert rows(spark.range(1).select(start, end)) == [python_bounds(when.date())]


@pytest.mark.parametrize(
    "as_of",
    [
        "2024-07-03",
        "2024-07-03 23:59:59",
        date(2024, 7, 3),
        datetime(2024, 7, 3, 23, 59),
        datetime(2024, 7, 4, 1, 0, tzinfo=timezone(timedelta(hours=2))),
    ],
)
def test_as_of_kinds(spark, zone, as_of):
    assert rows(spark.range(1).select(moment(as_of).cast("date"))) == [(date(2024, 7, 3),)]


def test_default_as_of_is_utc_now(spark, zone):
    (now,), = rows(spark.range(1).select(moment()))
    assert abs(now - datetime.now(timezone.utc).replace(tzinfo=None)) < timedelta(minutes=2)


WINDOW_ROWS = [
    ("2024-06-30 00:00:59.999", False),
    ("2024-06-30 00:01:00", True),
    ("2024-07-06 08:58:59.999", True),
    ("2024-07-06 08:59:00", False),
    ("2024-07-07 00:01:00", False),
    (None, False),
]


@pytest.mark.parametrize("as_of", [f"2024-07-0{n}" for n in range(1, 8)])
def test_window_edges(spark, as_of):
    fact = spark.createDataFrame([(t,) for t, _ in WINDOW_ROWS], "text string").withColumn(
        "played_at", F.col("text").cast("timestamp_ntz")
    )
    kept = {r.text for r in in_week(fact, as_of).collect()}
    assert kept == {t for t, inside in WINDOW_ROWS if inside}


def test_gap_belongs_to_no_week(spark):
    fact = spark.createDataFrame(
        [("2024-07-06 08:59:00",), ("2024-07-07 00:00:59.999",)], "text string"
    ).withColumn("played_at", F.col("text").cast("timestamp_ntz"))
    for as_of in ("2024-07-01", "2024-07-07", "2024-07-08"):
        assert in_week(fact, as_of).count() == 0


def test_zoned_play_times_compare_in_the_session_zone(spark):
    fact = spark.createDataFrame([("2024-06-30 00:01:00",)], "text string").withColumn(
        "played_at", F.col("text").cast("timestamp")
    )
    assert in_week(fact, "2024-07-01").count() == 1


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("2024-07-01T12:34:56.789Z", datetime(2024, 7, 1, 12, 34, 56, 789000)),
        ("2024-03-10T02:30:00.000Z", datetime(2024, 3, 10, 2, 30)),
        ("2024-07-01T12:34:56Z", None),
        ("2024-07-01T12:34:56.7Z", None),
        ("2024-07-01T12:34:56.7891Z", None),
        ("2024-07-01T12:34:56.789", None),
        ("2024-07-01 12:34:56.789Z", None),
        ("2024-02-30T12:34:56.789Z", None),
        ("2024-13-01T12:34:56.789Z", None),
        ("2024-07-01T12:34:56.789Z\n", None),
        ('["2"]', None),
        ("", None),
        (None, None),
    ],
)
def test_parse_played_at(spark, zone, text, wanted):
    df = spark.createDataFrame([(text,)], "t string").select(parse_played_at(F.col("t")))
    assert rows(df) == [(wanted,)]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.datetimes(datetime(1970, 1, 1), datetime(2100, 1, 1)))
def test_play_time_text_round_trip(spark, when):
    text = F.lit(str(when)).cast("timestamp_ntz")
    cut = when.replace(microsecond=when.microsecond // 1000 * 1000)
    shown = cut.strftime("%Y-%m-%dT%H:%M:%S.") + f"{cut.microsecond // 1000:03d}Z"
    df = spark.range(1).select(
        format_played_at(text), parse_played_at(format_played_at(text))
    )
    assert rows(df) == [(shown, cut)]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("1999", date(1999, 1, 1)),
        ("1999-05", date(1999, 5, 1)),
        ("1999-05-07", date(1999, 5, 7)),
        ("bad", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_release_date(spark, text, wanted):
    df = spark.createDataFrame([(text,)], "t string").select(parse_release_date(F.col("t")))
    assert rows(df) == [(wanted,)]


def test_epoch_ms(spark, zone):
    ms = 1_719_923_696_789
    df = spark.createDataFrame([(ms,)], "ms long").select(epoch_ms(ms), epoch_ms(F.col("ms")))
    wanted = datetime(2024, 7, 2, 12, 34, 56, 789000)
    assert rows(df) == [(wanted, wanted)]
