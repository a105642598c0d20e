"""The history source and counted plays."""

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from playledger import plans
from playledger.functions import played_ms
from playledger.operators.entities import new_keys
from playledger.operators.listening import PLAY_MS, count_plays, unresolved
from playledger.schemas import FACT_TABLE
from playledger.sources import COUNTS_TABLE, FolderWarehouse, MissingTable, stream_history
from playledger.sources.history import FORMAT, MOST_RANGES, TimeRange, register, time_ranges
from playledger.star import Star
from tests.util import bag, plan, rows

T0 = 1_704_067_200_000  # 2024-01-01T00:00:00.000Z


def at(ms):
    return (datetime(1970, 1, 1) + timedelta(milliseconds=ms)).isoformat(timespec="milliseconds") + "Z"


def write(spark, path, *times):
    plays = spark.createDataFrame(
        [(at(t), f"s{t % 7}", "a", None) for t in times], "played_at string, song_id string, album_id string, artist_id string"
    )
    plays.withColumn(PLAY_MS, played_ms(plays["played_at"])).write.mode("append").parquet(path)


def run(spark, tmp_path, **options):
    stream = stream_history(spark, f"{tmp_path}/history", range_ms="1000", **options)
    sink = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint")
    query = sink.trigger(availableNow=True).start(f"{tmp_path}/plays")
    query.awaitTermination()
    return sorted(r["played_at"] for r in spark.read.schema("played_at string").parquet(f"{tmp_path}/plays").collect())


def test_ranges_cover_the_span_once():
    assert time_ranges(5, 5) == [] and time_ranges(9, 5) == []
    for after, until, width in ((0, 10, 3), (0, 9, 3), (7, 8, 100), (0, 10**13, 1)):
        found = time_ranges(after, until, width)
        assert len(found) <= MOST_RANGES
        assert found[0].after == after and found[-1].until == until
        assert all(a.until == b.after and a.after < a.until for a, b in zip(found, found[1:]))


def test_restart_goes_on_strictly_after_the_committed_offset(spark, tmp_path):
    write(spark, f"{tmp_path}/history", T0, T0 + 1, T0 + 5000)
    assert run(spark, tmp_path, after=T0) == [at(T0 + 1), at(T0 + 5000)]
    offsets = sorted((Path(tmp_path) / "checkpoint" / "offsets").glob("[0-9]*"))
    assert json.loads(offsets[-1].read_text().splitlines()[-1]) == {"ms": T0 + 5000}
    # Nothing new: nothing is read again.
    assert len(run(spark, tmp_path, after=T0)) == 2
    # One at the cursor is not after it; the option only counts for a new query.
    write(spark, f"{tmp_path}/history", T0 + 5000, T0 + 5001, T0 + 90_000)
    assert run(spark, tmp_path, after=0) == [at(t) for t in (T0 + 1, T0 + 5000, T0 + 5001, T0 + 90_000)]


def test_a_new_query_begins_now_and_an_empty_history_gives_nothing(spark, tmp_path):
    spark.createDataFrame([], "played_at string, song_id string, album_id string, artist_id string, played_ms long").write.parquet(
        f"{tmp_path}/history"
    )
    assert run(spark, tmp_path) == []
    write(spark, f"{tmp_path}/history", T0)
    assert run(spark, tmp_path) == []


def test_a_history_that_lost_its_newest_plays_does_not_move_the_cursor_back(spark, tmp_path):
    write(spark, f"{tmp_path}/history", T0 + 7)
    assert len(run(spark, tmp_path, after=0)) == 1
    write(spark, f"{tmp_path}/older", T0)
    stream = stream_history(spark, f"{tmp_path}/older", after=0)
    sink = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint")
    with pytest.raises(Exception, match=f"after={T0 + 7}"):
        sink.trigger(availableNow=True).start(f"{tmp_path}/plays").awaitTermination()


def test_batch_read_of_a_span(spark, tmp_path):
    write(spark, f"{tmp_path}/history", *range(T0, T0 + 50))
    register(spark)
    reader = spark.read.format(FORMAT).option("path", f"{tmp_path}/history").option("range_ms", "7")
    assert reader.load().count() == 50
    assert reader.option("after", T0 + 9).option("until", T0 + 19).load().count() == 10
    with pytest.raises(Exception, match="range_ms"):
        reader.option("range_ms", "0").load().count()


def test_a_service_of_ones_own(spark, tmp_path):
    register(spark)
    service = f"{__name__}:TwoPlays"
    found = spark.read.format(FORMAT).option("service", service).load()
    assert sorted(r["song_id"] for r in found.collect()) == ["one", "two"]


class TwoPlays:
    def __init__(self, options):
        pass

    def times(self):
        return T0, T0 + 1

    def plays(self, after, until):
        import pyarrow as pa

        some = [(t, s) for t, s in ((T0, "one"), (T0 + 1, "two")) if after < t <= until]
        if some:
            times, songs = zip(*some)
            yield pa.RecordBatch.from_pydict(
                {"played_at": [at(t) for t in times], "song_id": songs, "album_id": songs, "artist_id": songs}
            )


def test_played_ms(spark, zone):
    texts = spark.createDataFrame([("2024-01-01T00:00:00.001Z",), ("2024-01-01",), (None,), ("[x]",)], "t string")
    assert [r[0] for r in rows(texts.select(played_ms(texts["t"])))] == [T0 + 1, None, None, None]


# --- counted plays ------------------------------------------------------------------------------

FACT = "song_id string, album_id string, artist_id string, played_at timestamp_ntz"


def plays(spark, *given):
    return spark.createDataFrame([(s, "a", "r", t and datetime.fromisoformat(t)) for s, t in given], FACT)


def star(spark, fact):
    return Star(
        fact,
        spark.createDataFrame([("s1", "One", 60_000), ("s2", "Two", 90_000)], "song_id string, title string, duration_ms int"),
        spark.createDataFrame([("a", "Album", "art")], "album_id string, title string, image_url string"),
        spark.createDataFrame([("r", "Artist")], "artist_id string, name string"),
    )


FIRST = [("s1", "2024-06-30 00:00:59.999"), ("s1", "2024-06-30 00:01:00"), ("s1", "2024-07-06 08:58:59.999"), ("s2", "2024-07-06 08:59:00")]
LATE = [("s2", "2024-07-02 10:00:00"), ("s2", None), ("s1", "2024-07-09 00:00:00"), ("s3", "2024-07-02 10:00:00"), (None, "2024-07-02 10:00:00")]
DATES = ["2024-07-03", "2024-06-25", "2024-07-10", "2024-06-30"]


def test_recaps_from_counts_after_late_plays_and_a_replay(spark, tmp_path):
    warehouse = FolderWarehouse(str(tmp_path), keep_counts=True)
    warehouse.append(plays(spark, *FIRST), FACT_TABLE, "q.0")
    for _ in range(2):
        warehouse.append(plays(spark, *LATE), FACT_TABLE, "q.1")
    counted = star(spark, warehouse.counted_star(spark).fact)
    whole = star(spark, plays(spark, *FIRST, *LATE))
    assert bag(plans.recap_tables(counted, DATES)) == bag(plans.recap_tables(whole, DATES))
    for date in DATES:
        assert bag(plans.recap_table(counted, date)) == bag(plans.recap_table(whole, date))
    physical = plan(plans.recap_tables(counted, DATES))
    assert COUNTS_TABLE in physical and FACT_TABLE not in physical


def test_counts_can_be_put_together(spark):
    both = count_plays(plays(spark, *FIRST, *LATE))
    parts = count_plays(plays(spark, *FIRST)).unionAll(count_plays(plays(spark, *LATE)))
    assert bag(plans.recap_tables(star(spark, parts), DATES)) == bag(plans.recap_tables(star(spark, both), DATES))
    assert sum(r["plays"] for r in both.collect()) == len(FIRST) + len(LATE)


def test_a_week_of_counts_reads_its_days(spark, tmp_path):
    warehouse = FolderWarehouse(str(tmp_path), keep_counts=True)
    warehouse.append(plays(spark, *FIRST, *LATE), FACT_TABLE, "q.0")
    counted = star(spark, warehouse.counted_star(spark).fact)
    assert "play_date" in plan(plans.top_songs(counted, "2024-07-03")).split("PartitionFilters")[1][:200]


def test_idempotent_batches_count_what_they_append(spark, tmp_path):
    warehouse = FolderWarehouse(str(tmp_path), idempotent=True, keep_counts=True)
    for batch in ("q.0", "q.1", "q.1"):
        warehouse.append(plays(spark, *FIRST), FACT_TABLE, batch)
    counted = warehouse.counted_star(spark).fact
    assert sum(r["plays"] for r in counted.collect()) == len(FIRST)


def test_counts_that_were_not_kept(spark, tmp_path):
    with pytest.raises(MissingTable):
        FolderWarehouse(str(tmp_path)).counted_star(spark)


def test_unresolved_counts_first_and_new_keys_scan_once(spark, tmp_path):
    plays(spark, *FIRST, *LATE).write.parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    known = star(spark, fact)
    assert plan(unresolved(fact, known)).count("FileScan") == 1
    assert bag(unresolved(fact, known)) == {("song", "s3", 1): 1, ("song", None, 1): 1}
    found = new_keys(fact, known.song, "song_id")
    assert plan(found).count("FileScan") == 1 and bag(found) == {("s3",): 1}
    assert bag(new_keys(fact, known.song, "song_id", persisted=True)) == {("s3",): 1}
