"""Redelivered plays, details that come late, and counts of batches."""

from collections import Counter
from datetime import datetime

import pytest

from playledger.functions import event_time
from playledger.schemas import FACT_TABLE, ITEM_TOPIC, SONG_TABLE, SONG_TOPIC
from playledger.sources import REJECTS_TABLE, FolderTopics, FolderWarehouse
from playledger.streaming import BatchMetrics, Redelivery, dispatch, mend, open_rejects, with_arrival
from playledger.streaming.metrics import totals
from tests.util import bag, messages, rows

ONCE = {"availableNow": True}
ITEM = '{"song_id":"%s","album_id":"a","artist_id":"r","played_at":"%s"}'


def item(song, time):
    return ITEM % (song, f"2024-07-{time}:00.000Z")


class Job:
    def __init__(self, spark, root, delay="2 hours"):
        self.spark, self.root = spark, root
        self.topics, self.warehouse = FolderTopics(f"{root}/topics"), FolderWarehouse(f"{root}/warehouse")
        self.again = Redelivery(f"{root}/staged", delay)

    def deliver(self, name, *texts):
        self.topics.append(messages(self.spark, *texts, topic=ITEM_TOPIC), name)
        stream = self.topics.read_stream(self.spark)
        dispatch(stream, self.warehouse, f"{self.root}/dispatch", ONCE, redelivery=self.again).awaitTermination()

    def settle(self):
        query = self.again.settle(self.spark, self.warehouse, f"{self.root}/settle", ONCE)
        query.awaitTermination()
        return query

    def plays(self):
        read = self.warehouse.read(self.spark, FACT_TABLE, missing_ok=True)
        return Counter((r["song_id"], f"{r['played_at']:%d %H:%M}") for r in read.collect())

    def rejects(self):
        return Counter(r["json_value"] for r in self.warehouse.read(self.spark, REJECTS_TABLE, missing_ok=True).collect())


def test_a_record_counts_once_within_the_delay_and_is_rejected_later(spark, tmp_path):
    job = Job(spark, str(tmp_path))
    job.deliver("1", item("s1", "01T10:00"), item("s1", "01T10:00"), item("s2", "01T10:30"))
    job.settle()
    # Again within the delay, one that is new although it is older, and the newest so far.
    job.deliver("2", item("s1", "01T10:00"), item("s3", "01T09:00"), item("s4", "01T12:00"))
    job.settle()
    assert job.plays() == {("s1", "01 10:00"): 1, ("s2", "01 10:30"): 1, ("s3", "01 09:00"): 1, ("s4", "01 12:00"): 1}
    assert not job.rejects()
    # Exactly at the delay, and a minute past it: the second copy of s3 can no longer be told apart.
    job.deliver("3", item("s1", "01T10:00"), item("s3", "01T09:00"), item("s5", "01T09:59"))
    job.settle()
    assert sum(job.plays().values()) == 4 and job.plays()[("s1", "01 10:00")] == 1
    assert sum(job.rejects().values()) == 2
    assert {t[:15] for t in job.rejects()} == {'{"song_id":"s3"', '{"song_id":"s5"'}


def test_staged_plays_of_several_batches_settle_together(spark, tmp_path):
    """The second stream may lag behind, and drops nothing as late."""
    job = Job(spark, str(tmp_path))
    job.deliver("1", item("s1", "01T10:00"))
    job.deliver("2", item("s2", "03T10:00"), item("s2", "03T10:00"))
    job.deliver("3", item("s2", "03T10:00"), item("s3", "03T08:00"))
    query = job.settle()
    assert job.plays() == {("s1", "01 10:00"): 1, ("s2", "03 10:00"): 1, ("s3", "03 08:00"): 1}
    for progress in query.recentProgress:
        assert all(s.numRowsDroppedByWatermark == 0 for s in progress.stateOperators)


def test_plays_without_a_time_or_a_key_are_rejects_of_one_batch(spark, tmp_path):
    job = Job(spark, str(tmp_path))
    job.deliver("1", item("s1", "01T10:00"), ITEM % ("s9", "no time"), '{"album_id":"a"}', "{bad")
    job.settle()
    assert sum(job.plays().values()) == 1 and sum(job.rejects().values()) == 3


def test_screening_a_batch_again_finds_the_same(spark, tmp_path):
    again = Redelivery(str(tmp_path), "2 hours")
    schema = "song_id string, album_id string, artist_id string, played_at timestamp_ntz"

    def plays(*hours):
        return spark.createDataFrame([("s", "a", "r", datetime(2024, 7, 1, h)) for h in hours], schema)

    assert again.screen(plays(10, 3), 0, "q.0").count() == 0
    for _ in range(2):  # a replay
        assert again.screen(plays(9, 7, 20), 1, "q.1").count() == 1
    assert again.screen(plays(17, 18), 2, "q.2").count() == 1
    # A batch without plays leaves the clock as it is.
    assert again.screen(plays(), 3, "q.3").count() == 0
    assert again.screen(plays(17, 18), 4, "q.4").count() == 1
    staged = spark.read.parquet(f"{tmp_path}/plays")
    assert Counter(r["batch"] for r in staged.collect()) == {"q.0": 2, "q.1": 2, "q.2": 1, "q.4": 1}


# --- late details -------------------------------------------------------------------------------


def test_plays_wait_for_details_and_are_emitted_once(spark, tmp_path, zone):
    day = lambda d, h=0: datetime(2024, 7, d, h)
    batches = [
        ([("now", day(1, 1)), ("soon", day(1, 2)), ("never", day(1, 3)), (None, day(1, 4))], [("now", day(1))]),
        ([("later", day(2))], [("soon", day(2, 2))]),
        ([("now", day(4)), ("old", day(4, 1))], [("later", day(4, 1)), ("never", day(4, 2))]),
        ([(None, day(20))], [("heartbeat", day(20))]),
    ]
    sides = (("plays", "song_id string, played_at timestamp_ntz"), ("arrivals", "song_id string, arrived_at timestamp_ntz"))
    for i, (name, schema) in enumerate(sides):
        # A folder that exists before the stream starts.
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}")
    streams = [spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}") for name, schema in sides]
    found = with_arrival(*streams, "song_id", wait="2 days", before="3 days")
    assert found.columns == ["song_id", "played_at", "arrived_at"]
    after = []
    for batch in batches:
        for part, (name, schema) in zip(batch, sides):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        sink = found.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint")
        sink.trigger(availableNow=True).start(f"{tmp_path}/found").awaitTermination()
        after.append(Counter((r[0], r[1], r[2]) for r in spark.read.schema(found.schema).parquet(f"{tmp_path}/found").collect()))
    assert after[0] == {("now", day(1, 1), day(1)): 1}
    assert after[1] == after[0] | {("soon", day(1, 2), day(2, 2)): 1}
    # Details that come after two days are too late: unresolved, emitted once.
    assert after[3] == Counter(
        {
            ("now", day(1, 1), day(1)): 1, ("soon", day(1, 2), day(2, 2)): 1, ("never", day(1, 3), None): 1, (None, day(1, 4), None): 1,
            ("later", day(2), None): 1, ("now", day(4), day(1)): 1, ("old", day(4, 1), None): 1,
        }
    )


def test_event_time_is_the_same_in_any_zone(spark, zone):
    times = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS t")
    micros = times.selectExpr("unix_micros(cast(concat(cast(t AS string), 'Z') AS timestamp)) AS m").first()[0]
    assert rows(times.select(event_time(times["t"]).cast("double"))) == [(micros / 1e6,)] and micros == 1_710_037_800_123_456


# --- counts of batches --------------------------------------------------------------------------


@pytest.fixture
def metrics(spark, tmp_path):
    listener = BatchMetrics(spark, f"{tmp_path}/metrics")
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def test_counts_outlive_the_query(spark, tmp_path, metrics):
    topics, warehouse = FolderTopics(f"{tmp_path}/topics"), FolderWarehouse(f"{tmp_path}/warehouse")
    songs = ['{"song_id":"s1"}', '{"song_id":"s2"}', '{"title":"no key"}', "{bad"]
    for name, texts, topic in (("1", songs, SONG_TOPIC), ("2", songs[:1], SONG_TOPIC), ("3", [item("s1", "01T10:00")], ITEM_TOPIC)):
        topics.append(messages(spark, *texts, topic=topic), name)
        query = dispatch(topics.read_stream(spark), warehouse, f"{tmp_path}/checkpoint", ONCE)
        query.awaitTermination()
        assert metrics.wait(query.runId)
    found = metrics.read()
    assert bag(found.select("batch_id", "topic", "n_records", "n_rejects")) == {
        (0, SONG_TOPIC, 4, 2): 1, (1, SONG_TOPIC, 1, 0): 1, (2, ITEM_TOPIC, 1, 0): 1,
    }
    assert {r["query"] for r in found.collect()} == {str(query.id)}
    assert bag(totals(found)) == {(SONG_TOPIC, 5, 2): 1, (ITEM_TOPIC, 1, 0): 1}
    assert warehouse.read(spark, SONG_TABLE).count() == 2


# --- mended rejects -----------------------------------------------------------------------------


def rejected(spark, tmp_path):
    """A warehouse with four rejects and one song, and the rejects by text."""
    topics, warehouse = FolderTopics(f"{tmp_path}/topics"), FolderWarehouse(f"{tmp_path}/warehouse")
    texts = ['{"song_id":"s1","title":"One"}', '{"title":"two"}', '{"title":"two"}', "{bad"]
    topics.append(messages(spark, *texts, topic=SONG_TOPIC), "1")
    topics.append(messages(spark, '{"played_at":"2024-07-01T10:00:00.000Z"}', topic=ITEM_TOPIC), "2")
    dispatch(topics.read_stream(spark), warehouse, f"{tmp_path}/checkpoint", ONCE).awaitTermination()
    found = {}
    for r in warehouse.batches(spark, REJECTS_TABLE).collect():
        found.setdefault(r["json_value"], []).append(r["origin"])
    return warehouse, found


def test_rejects_have_an_origin_of_their_own(spark, tmp_path):
    warehouse, found = rejected(spark, tmp_path)
    origins = [o for some in found.values() for o in some]
    assert len(origins) == len(set(origins)) == 4 and all("/" in o for o in origins)
    assert len(found['{"title":"two"}']) == 2
    assert open_rejects(spark, warehouse).count() == 4


@pytest.mark.parametrize("order", [("a", "b"), ("b", "a")])
def test_a_mended_reject_is_taken_in_once_whichever_run_comes_first(spark, tmp_path, order):
    warehouse, found = rejected(spark, tmp_path)
    two, bad, play = found['{"title":"two"}'], found["{bad"][0], found['{"played_at":"2024-07-01T10:00:00.000Z"}'][0]
    runs = {
        "a": [(two[0], '{"song_id":"s2","title":"a"}'), (bad, "{still bad"), ("unknown/1", '{"song_id":"x"}'), (None, '{"song_id":"x"}')],
        "b": [(two[0], '{"song_id":"s3","title":"b"}'), (two[1], '{"song_id":"s1","title":"known"}'), (play, item("s2", "01T10:00"))],
    }
    for run in (order[0], order[0], order[1], order[1], order[0]):  # repeated, too
        rest = mend(spark, warehouse, spark.createDataFrame(runs[run], "origin string, json_value string"), run)
    songs = {r["song_id"]: r["title"] for r in warehouse.read(spark, SONG_TABLE).collect()}
    assert songs == {"s1": "One"} | ({"s2": "a"} if order[0] == "a" else {"s3": "b"})
    assert warehouse.read(spark, FACT_TABLE).count() == 1
    assert [r["json_value"] for r in rest.collect()] == ["{bad"]


def test_late_plays_are_rejects_that_stay(spark, tmp_path):
    job = Job(spark, str(tmp_path))
    job.deliver("1", item("s1", "03T10:00"), "{bad")
    job.deliver("2", item("s1", "01T10:00"))
    assert sum(job.rejects().values()) == 2
    assert [r["json_value"] for r in open_rejects(spark, job.warehouse).collect()] == ["{bad"]
