import json
from datetime import datetime

import pytest

from playledger.operators.listening import unresolved
from playledger.operators.messages import decode, parse_records, parse_topic
from playledger.plans import forgotten_songs, top_songs
from playledger.schemas import (
    ALBUM_TOPIC,
    ARTIST_TOPIC,
    FACT_TABLE,
    ITEM_TOPIC,
    SONG_TABLE,
    SONG_TOPIC,
    TOPICS,
)
from playledger.sources import REJECTS_TABLE, FolderTopics, FolderWarehouse, stream_pages
from playledger.streaming import dispatch, ingest, run_until_stopped
from playledger.streaming.dispatch import METRICS, _write_batch
from tests.test_ingest import play
from tests.util import bag, messages, plan, rows

ONCE = {"availableNow": True}

SONG = '{"song_id":"%s","title":"%s","duration_ms":60000}'
ALBUM = '{"album_id":"a1","title":"Album","image_url":"art"}'
ARTIST = '{"artist_id":"r1","name":"Artist"}'
ITEM = '{"song_id":"%s","album_id":"a1","artist_id":"r1","played_at":"%s"}'
AT = "2024-07-01T10:00:00.000Z"


@pytest.fixture
def setup(spark, tmp_path):
    return (
        FolderTopics(str(tmp_path / "topics")),
        FolderWarehouse(str(tmp_path / "warehouse")),
        str(tmp_path / "checkpoint"),
    )


def publish(spark, topics, batch, **texts):
    frames = [messages(spark, *t, topic=f"{name}_topic") for name, t in texts.items()]
    records = frames[0]
    for frame in frames[1:]:
        records = records.unionByName(frame)
    topics.append(records, batch)


def run(spark, setup, **options):
    topics, warehouse, checkpoint = setup
    query = dispatch(topics.read_stream(spark), warehouse, checkpoint, ONCE, **options)
    query.awaitTermination()
    return query


def test_stream_gives_what_the_batch_gives(spark, setup):
    topics, warehouse, _ = setup
    publish(spark, topics, "1", song=[SONG % ("s1", "One")], album=[ALBUM], artist=[ARTIST],
            item=[ITEM % ("s1", AT), ITEM % ("s2", AT), ITEM % ("s1", "no time")])
    run(spark, setup)
    for name, topic in TOPICS.items():
        wanted = parse_topic(decode(topics.read(spark)), name)
        stored = warehouse.read(spark, topic.table).drop("play_date")
        assert stored.schema == wanted.schema
        assert bag(stored) == bag(wanted)


def test_second_run_adds_nothing_and_later_records_are_added(spark, setup):
    topics, warehouse, _ = setup
    publish(spark, topics, "1", item=[ITEM % ("s1", AT)])
    run(spark, setup)
    run(spark, setup)
    assert warehouse.read(spark, FACT_TABLE).count() == 1
    publish(spark, topics, "2", item=[ITEM % ("s1", AT)])
    run(spark, setup)
    assert warehouse.read(spark, FACT_TABLE).count() == 2


def test_new_checkpoint_keeps_what_the_old_query_wrote(spark, setup, tmp_path):
    topics, warehouse, _ = setup
    publish(spark, topics, "1", item=[ITEM % ("s1", AT)])
    run(spark, setup)
    run(spark, (topics, warehouse, str(tmp_path / "other")))
    assert warehouse.read(spark, FACT_TABLE).count() == 2


@pytest.mark.parametrize("unique_dims", [True, False])
def test_replayed_batch_counts_once(spark, setup, unique_dims):
    _, warehouse, _ = setup
    records = decode(
        messages(spark, SONG % ("s1", "One"), "{bad", topic=SONG_TOPIC).unionByName(
            messages(spark, ITEM % ("s1", AT), ITEM % ("s1", AT), topic=ITEM_TOPIC)
        )
    )
    for tag in ("q.0", "q.0", "q.0"):
        _write_batch(parse_records(records), tag, warehouse, unique_dims, True)
    assert warehouse.read(spark, FACT_TABLE).count() == 2
    assert warehouse.read(spark, SONG_TABLE).count() == 1
    assert rows(warehouse.read(spark, REJECTS_TABLE)) == [(SONG_TOPIC, "{bad")]


def test_dimension_keys_stay_unique_within_and_across_batches(spark, setup):
    topics, warehouse, _ = setup
    publish(spark, topics, "1", song=[SONG % ("s1", "One"), SONG % ("s1", "Uno"),
                                      '{"song_id":"s1"}', SONG % ("s2", "Two")])
    run(spark, setup)
    publish(spark, topics, "2", song=[SONG % ("s1", "Zzz"), SONG % ("s3", "Three")])
    run(spark, setup)
    found = warehouse.read(spark, SONG_TABLE).select("song_id", "title")
    assert bag(found) == {("s1", "Uno"): 1, ("s2", "Two"): 1, ("s3", "Three"): 1}


def test_everything_is_appended_on_request(spark, setup):
    topics, warehouse, _ = setup
    publish(spark, topics, "1", song=[SONG % ("s1", "One"), SONG % ("s1", "One"), "{bad"])
    run(spark, setup, unique_dims=False, keep_rejects=False)
    found = warehouse.read(spark, SONG_TABLE).select("song_id")
    assert bag(found) == {("s1",): 2, (None,): 1}
    assert warehouse.read(spark, REJECTS_TABLE, missing_ok=True).count() == 0


def test_topics_without_records_are_not_written(spark, setup, tmp_path):
    topics, warehouse, _ = setup
    publish(spark, topics, "1", item=[ITEM % ("s1", AT)], other=["{}"])
    run(spark, setup)
    assert {p.name for p in (tmp_path / "warehouse").iterdir()} == {FACT_TABLE}
    assert warehouse.read(spark, SONG_TABLE, missing_ok=True).count() == 0


def test_late_dimension_counts_as_soon_as_it_arrives(spark, setup):
    topics, warehouse, _ = setup
    publish(spark, topics, "1", album=[ALBUM], artist=[ARTIST], item=[ITEM % ("s1", AT)])
    run(spark, setup)
    star = warehouse.star(spark)
    assert rows(top_songs(star, "2024-07-03")) == []
    assert rows(unresolved(star.fact, star)) == [("song", "s1", 1)]
    publish(spark, topics, "2", song=[SONG % ("s1", "One")])
    run(spark, setup)
    star = warehouse.star(spark)
    assert rows(top_songs(star, "2024-07-03")) == [("One", "Album", "Artist", "art", 1)]
    assert rows(unresolved(star.fact, star)) == []


def test_counts_per_batch_are_observed(spark, setup):
    topics, _, _ = setup
    publish(spark, topics, "1", song=[SONG % ("s1", "One")], item=[ITEM % ("s1", AT)] * 3)
    query = run(spark, setup)
    counts = query.recentProgress[0].observedMetrics[METRICS].asDict()
    assert counts == {SONG_TOPIC: 1, ALBUM_TOPIC: 0, ARTIST_TOPIC: 0, ITEM_TOPIC: 3}


def test_recap_of_the_stored_star_reads_the_days_of_its_week(spark, setup):
    topics, warehouse, _ = setup
    publish(spark, topics, "1", song=[SONG % ("s1", "One")], album=[ALBUM], artist=[ARTIST],
            item=[ITEM % ("s1", f"2024-07-{d:02d}T10:00:00.000Z") for d in range(1, 29)])
    run(spark, setup)
    recap = top_songs(warehouse.star(spark), "2024-07-03")
    assert rows(recap) == [("One", "Album", "Artist", "art", 5)]
    assert "play_date" in plan(recap).split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_running_query_stops_on_request(spark, setup):
    topics, warehouse, checkpoint = setup
    publish(spark, topics, "1", item=[ITEM % ("s1", AT)])
    query = dispatch(topics.read_stream(spark), warehouse, checkpoint,
                     {"processingTime": "1 second"})
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    run_until_stopped(query)
    assert not query.isActive
    assert warehouse.read(spark, FACT_TABLE).count() == 1


def test_pages_to_recaps_through_both_streams(spark, setup, tmp_path):
    topics, warehouse, checkpoint = setup
    landing = tmp_path / "pages"
    landing.mkdir()

    def land(name, *pages):
        text = "\n".join(json.dumps({"items": list(p)}) for p in pages)
        (landing / f"{name}.json").write_text(text)

    def details(kind, **payloads):
        frame = spark.createDataFrame(
            [(k, json.dumps(p)) for k, p in payloads.items()],
            f"{kind}_id string, payload string",
        )
        frame.write.parquet(str(tmp_path / "entities" / kind))

    details("song", s1={"name": "One", "duration_ms": 60_000}, s2={"name": "Two", "duration_ms": 1})
    details("album", a1={"name": "Album", "images": [{"url": "art"}], "release_date": "1999"})
    details("artist", r1={"name": "Artist", "followers": {"total": 3}, "images": []})

    def both():
        ingest(stream_pages(spark, str(landing)), warehouse, str(tmp_path / "entities"), topics,
               str(tmp_path / "ingest"), ONCE).awaitTermination()
        run(spark, setup)

    land("1", [play(AT, "s1"), play(AT, "s1")], [])
    both()
    land("2", [play("2024-07-02T10:00:00.000Z", "s1"), play("2024-06-01T10:00:00.000Z", "s2")])
    land("3", [])
    both()
    both()
    records = decode(topics.read(spark))
    assert bag(records.groupBy("topic").count()) == {
        (SONG_TOPIC, 2): 1, (ALBUM_TOPIC, 1): 1, (ARTIST_TOPIC, 1): 1, (ITEM_TOPIC, 4): 1,
    }
    star = warehouse.star(spark)
    assert rows(top_songs(star, "2024-07-03")) == [("One", "Album", "Artist", "art", 3)]
    assert rows(forgotten_songs(star, "2024-07-03")) == [
        ("Two", "art", datetime(2024, 6, 1, 10), 32),
        ("One", "art", datetime(2024, 7, 2, 10), 1),
    ]
