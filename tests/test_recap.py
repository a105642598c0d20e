import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest

from playledger.operators.listening import (
    in_week,
    in_weeks,
    minutes_by,
    plays_by,
    resolve,
    top_k,
    unresolved,
)
from playledger.plans import (
    SECTIONS,
    forgotten_songs,
    recap_table,
    recap_tables,
    recaps,
    top_albums,
    top_artists,
    top_songs,
)
from playledger.star import Star
from tests.util import bag, plan, rows

AS_OF = "2024-07-03"
IN_WEEK = datetime(2024, 7, 2, 12)


def make_star(spark, fact, song, album=None, artist=None):
    album = [("a", "Album", "art")] if album is None else album
    artist = [("r", "Artist")] if artist is None else artist
    return Star(
        spark.createDataFrame(
            fact, "song_id string, album_id string, artist_id string, played_at timestamp_ntz"
        ),
        spark.createDataFrame(song, "song_id string, title string, duration_ms int"),
        spark.createDataFrame(album, "album_id string, title string, image_url string"),
        spark.createDataFrame(artist, "artist_id string, name string"),
    )


def played(*songs):
    return [(s, "a", "r", IN_WEEK) for s in songs]


def test_same_names_merge_and_the_sum_is_floored(spark):
    star = make_star(
        spark, played("s1", "s2", "s3"),
        [("s1", "Song", 59_999), ("s2", "Song", 1), ("s3", "Song", 60_001)],
    )
    assert rows(top_songs(star, AS_OF)) == [("Song", "Album", "Artist", "art", 2)]


def test_unknown_and_null_keys_are_dropped(spark):
    fact = played("s1", "zz", None) + [("s1", "zz", "r", IN_WEEK), ("s1", None, "r", IN_WEEK)]
    star = make_star(spark, fact, [("s1", "Song", 60_000), (None, "Null", 60_000)])
    assert rows(top_songs(star, AS_OF)) == [("Song", "Album", "Artist", "art", 1)]
    # The artist recap needs no album.
    assert rows(top_artists(star, AS_OF)) == [("Artist", 3)]


def test_null_durations(spark):
    star = make_star(
        spark, played("s1", "s2", "s3"),
        [("s1", "A", None), ("s2", "B", 0), ("s3", "B", None)],
    )
    assert [(r[0], r[-1]) for r in rows(top_songs(star, AS_OF))] == [("B", 0), ("A", None)]


def test_ties_at_the_cut_go_by_the_keys(spark):
    names = [f"Song {n:02d}" for n in range(14)]
    star = make_star(
        spark, played(*names), [(n, n, 60_000) for n in reversed(names)]
    )
    assert [r.song_name for r in top_songs(star, AS_OF).collect()] == names[:10]
    assert [r.song_name for r in top_songs(star, AS_OF, k=3).collect()] == names[:3]


def test_days_count_calendar_dates(spark):
    star = make_star(
        spark, [("s1", "a", "zz", datetime(2024, 7, 2, 23, 59, 59))], [("s1", "Song", 1)]
    )
    assert rows(forgotten_songs(star, "2024-07-03 00:00:01")) == [
        ("Song", "art", datetime(2024, 7, 2, 23, 59, 59), 1)
    ]


def test_forgotten_songs_have_no_minimum_age_and_keep_null_times(spark):
    star = make_star(
        spark,
        [("s1", "a", "r", datetime(2024, 7, 3)), ("s2", "a", "r", None)],
        [("s1", "New", 1), ("s2", "Never", 1)],
    )
    assert rows(forgotten_songs(star, AS_OF)) == [
        ("New", "art", datetime(2024, 7, 3), 0),
        ("Never", "art", None, None),
    ]


def test_totals_beyond_double_precision_are_exact(spark):
    star = make_star(spark, [], [("s1", "Song", 59_999)])
    n = 2**47 + 1
    plays = spark.createDataFrame([("s1", n)], "song_id string, plays long")
    found = minutes_by(resolve(plays, star, "song_id"), "song_name")
    assert n * 59_999 > 2**62
    assert rows(found) == [("Song", n * 59_999 // 60_000)]


# --- against plain Python -----------------------------------------------------------------------


def random_tables(seed):
    rnd = random.Random(seed)
    ids = [f"k{n}" for n in range(12)]

    def pick():
        # One key holds a third of all plays; some keys are unknown or NULL.
        return "k0" if rnd.random() < 0.34 else rnd.choice(ids + ["unknown", None])

    start = datetime(2024, 6, 25)
    fact = [
        (pick(), pick(), pick(),
         None if rnd.random() < 0.05 else start + timedelta(minutes=rnd.randrange(20 * 24 * 60)))
        for _ in range(1500)
    ]

    def dim(make):
        found = [(i, *make()) for i in ids if rnd.random() < 0.9]
        return found + found[:2]  # two keys occur twice

    song = dim(lambda: (rnd.choice(["A", "B", "C", None]), rnd.choice([None, 1, 59_999, 200_000])))
    album = dim(lambda: (rnd.choice(["X", "Y"]), rnd.choice(["p", "q", None])))
    artist = dim(lambda: (rnd.choice(["M", "N", "O"]),))
    return fact, song, album, artist


def grouped(fact, dims, name_of, start=None, end=None):
    """Joined plays by name group: list of (duration, played_at)."""
    groups = defaultdict(list)
    for song_id, album_id, artist_id, at in fact:
        if start and (at is None or not start <= at < end):
            continue
        ids = dict(song=song_id, album=album_id, artist=artist_id)
        joined = [{}]
        for kind, table in dims.items():
            joined = [
                row | {kind: entry}
                for row in joined
                for entry in table
                if ids[kind] is not None and entry[0] == ids[kind]
            ]
        for row in joined:
            groups[name_of(row)].append((row["song"][2], at))
    return groups


def first_k(found, k):
    """By the last column descending, NULLs last, then by the other columns, NULLs first."""
    def order(row):
        *keys, measure = row
        return (measure is None, -(measure or 0), [(x is not None, x or "") for x in keys])
    return sorted(found, key=order)[:k]


def minutes(plays):
    known = [d for d, _ in plays if d is not None]
    return sum(known) // 60_000 if known else None


@pytest.mark.parametrize("joins", ["broadcast", "sorted"])
@pytest.mark.parametrize("seed", [1, 2])
def test_recaps_match_plain_python(spark, request, seed, joins):
    if joins == "sorted":
        request.getfixturevalue("no_broadcast")
    fact, song, album, artist = random_tables(seed)
    star = make_star(spark, fact, song, album, artist)
    week = (datetime(2024, 6, 30, 0, 1), datetime(2024, 7, 6, 8, 59))
    all_dims = dict(song=song, album=album, artist=artist)

    groups = grouped(fact, all_dims,
                     lambda r: (r["song"][1], r["album"][1], r["artist"][1], r["album"][2]), *week)
    assert rows(top_songs(star, AS_OF)) == first_k(
        [(*names, minutes(p)) for names, p in groups.items()], 10
    )
    groups = grouped(fact, all_dims, lambda r: (r["album"][1], r["artist"][1], r["album"][2]), *week)
    assert rows(top_albums(star, AS_OF)) == first_k(
        [(*names, minutes(p)) for names, p in groups.items()], 5
    )
    groups = grouped(fact, dict(song=song, artist=artist), lambda r: (r["artist"][1],), *week)
    assert rows(top_artists(star, AS_OF)) == first_k(
        [(*names, minutes(p)) for names, p in groups.items()], 5
    )
    groups = grouped(fact, dict(song=song, album=album), lambda r: (r["song"][1], r["album"][2]))
    seen = {n: [at for _, at in p if at is None or at.date() <= date(2024, 7, 3)] for n, p in groups.items()}
    last = {n: max((at for at in p if at), default=None) for n, p in seen.items() if p}
    wanted = first_k(
        [(*n, at and (date(2024, 7, 3) - at.date()).days) for n, at in last.items()], 10
    )
    assert [(r.song_name, r.album_art, r.days_ago)
            for r in forgotten_songs(star, AS_OF).collect()] == wanted
    assert all(last[r.song_name, r.album_art] == r.last_played
               for r in forgotten_songs(star, AS_OF).collect())


def test_suite_holds_the_four_recaps_in_order(spark):
    star = make_star(spark, *random_tables(3))
    separate = recaps(star, AS_OF)
    assert list(separate) == [
        "Top 10 Songs",
        "Top 5 Albums",
        "Top 5 Artists",
        "Songs you haven't listened to in a while",
    ]
    table = recap_table(star, AS_OF)
    for section in SECTIONS:
        part = table.filter(table.section == section.name).orderBy("rank")
        recap = separate[section.name]
        assert rows(part.select(*recap.columns)) == rows(recap)
        ranks = [(r["rank"], r.section_no, r.as_of) for r in part.collect()]
        assert ranks == [(n + 1, section.number, date(2024, 7, 3)) for n in range(len(ranks))]


def test_several_dates_in_one_plan(spark):
    star = make_star(spark, *random_tables(6))
    dates = ["2024-06-26", "2024-07-03", "2024-07-05", "2024-07-08", "2025-01-01"]
    wanted = recap_table(star, dates[0])
    for day in dates[1:]:
        wanted = wanted.unionByName(recap_table(star, day))
    together = recap_tables(star, dates)
    assert together.schema.names == wanted.schema.names
    assert bag(together) == bag(wanted)
    assert bag(recap_tables(star, dates[:1])) == bag(recap_table(star, dates[0]))
    assert "WindowGroupLimit" in plan(together)


def test_unresolved_plays_by_dimension(spark):
    fact = played("s1", "s2", "s2", None) + [("s1", "x", "r", IN_WEEK)]
    star = make_star(spark, fact, [("s1", "Song", 1)])
    assert bag(unresolved(star.fact, star)) == {
        ("song", "s2", 2): 1,
        ("song", None, 1): 1,
        ("album", "x", 1): 1,
    }


def test_top_k_orders_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), (None, 1), ("c", 2)], "n string, m int")
    assert rows(top_k(df, 3, "m", "n")) == [("c", 2), (None, 1), ("b", 1)]


# --- plans --------------------------------------------------------------------------------------


@pytest.fixture
def stored_star(spark, tmp_path):
    star = make_star(spark, *random_tables(4))
    for name in ("fact", "song", "album", "artist"):
        getattr(star, name).write.parquet(str(tmp_path / name))
    return Star(*[spark.read.parquet(str(tmp_path / n)) for n in ("fact", "song", "album", "artist")])


def test_bounds_of_several_weeks_are_pushed_to_the_scan(stored_star):
    text = plan(in_weeks(stored_star.fact, ["2024-07-10", AS_OF]).select("song_id"))
    assert "GreaterThanOrEqual(played_at,2024-06-30T00:01)" in text
    assert "LessThan(played_at,2024-07-13T08:59)" in text


def test_bounds_are_pushed_to_the_scan(stored_star):
    for as_of in (AS_OF, None):
        text = plan(in_week(stored_star.fact, as_of).select("song_id"))
        assert "GreaterThanOrEqual(played_at" in text and "LessThan(played_at" in text
        assert "ReadSchema: struct<song_id:string,played_at:timestamp_ntz>" in text


def test_plays_are_aggregated_before_any_join(spark, stored_star, no_broadcast):
    text = plan(top_songs(stored_star, AS_OF))
    # The plan prints bottom-up by depth: nothing but the scan lies below the first aggregate.
    assert text.index("SortMergeJoin") < text.index("partial_count(1)")
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "TakeOrderedAndProject" in text
    scan = text[text.index("partial_count(1)"):]
    assert "Exchange" not in scan[: scan.index("FileScan")]


def test_suite_shares_the_week_between_songs_and_albums(spark, stored_star):
    table = recap_table(stored_star, AS_OF)
    table.collect()
    assert "ReusedExchange" in plan(table)


def test_partition_column_prunes_days(spark, tmp_path):
    star = make_star(spark, *random_tables(5))
    path = str(tmp_path / "fact")
    star.fact.withColumn("play_date", star.fact.played_at.cast("date")).write.partitionBy(
        "play_date"
    ).parquet(path)
    stored = spark.read.parquet(path)
    week = in_week(stored, AS_OF)
    assert "PartitionFilters: [isnotnull(play_date" in plan(week)
    assert bag(week.drop("play_date")) == bag(in_week(star.fact, AS_OF))
    assert bag(plays_by(week, "song_id")) == bag(plays_by(in_week(star.fact, AS_OF), "song_id"))


def test_forgotten_songs_as_they_were_on_a_past_day(spark):
    star = make_star(
        spark,
        [("s1", "a", "r", datetime(2024, 7, 1)), ("s1", "a", "r", datetime(2024, 7, 9)),
         ("s2", "a", "r", datetime(2024, 7, 3, 23, 59)), ("s3", "a", "r", datetime(2024, 7, 4))],
        [("s1", "Early", 1), ("s2", "Same day", 1), ("s3", "Later", 1)],
    )
    wanted = [("Early", "art", datetime(2024, 7, 1), 2), ("Same day", "art", datetime(2024, 7, 3, 23, 59), 0)]
    assert rows(forgotten_songs(star, AS_OF)) == wanted
    found = recap_tables(star, ["2024-07-03", "2024-07-20"]).filter("section_no = 4")
    found = bag(found.selectExpr("cast(as_of as string)", "song_name", "days_ago"))
    assert found == {
        ("2024-07-03", "Early", 2): 1, ("2024-07-03", "Same day", 0): 1,
        ("2024-07-20", "Early", 11): 1, ("2024-07-20", "Same day", 17): 1, ("2024-07-20", "Later", 16): 1,
    }


@pytest.mark.parametrize("seed", [4, 5])
def test_several_dates_are_the_union_of_single_ones(spark, seed):
    star = make_star(spark, *random_tables(seed))
    dates = ["2024-06-28", "2024-07-02", "2024-07-09", "2024-08-01"]
    wanted = sum((bag(recap_table(star, d)) for d in dates), Counter())
    assert bag(recap_tables(star, dates)) == wanted
    assert all(r.days_ago is None or r.days_ago >= 0 for r in recap_tables(star, dates).collect())


def test_a_date_counts_once_in_whatever_form(spark):
    star = make_star(spark, *random_tables(3))
    forms = ["2024-07-03", date(2024, 7, 3), datetime(2024, 7, 3, 12)]
    assert bag(recap_tables(star, forms)) == bag(recap_tables(star, forms[:1]))
    with pytest.raises(ValueError, match="at least one date"):
        recap_tables(star, [])


def test_far_weeks_leave_out_the_years_between(spark, tmp_path):
    star = make_star(spark, *random_tables(3))
    fact = star.fact.withColumn("play_date", star.fact["played_at"].cast("date"))
    fact.write.partitionBy("play_date").parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    filters = plan(in_weeks(fact, ["1992-07-03", "2001-07-03"])).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "OR" in filters.upper() and "1992-07-04" in filters and "2001-07-01" in filters
