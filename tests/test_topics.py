from datetime import date, datetime

import pytest

from playledger.operators.messages import (
    accepted,
    all_rows,
    decode,
    parse_records,
    parse_topic,
    rejected,
)
from playledger.schemas import ALBUM_TOPIC, ARTIST_TOPIC, ITEM_TOPIC, SONG_TOPIC, TOPICS
from playledger.sources import FolderTopics, KafkaTopics, kafka_options, kafka_package
from tests.util import bag, messages, rows


def parse(spark, text, topic=SONG_TOPIC):
    (row,) = parse_topic(decode(messages(spark, text, topic=topic)), topic).collect()
    return row.asDict()


@pytest.mark.parametrize("text", ["{bad", "", "[1]", "plain", '{"song_id":"a"'])
def test_malformed_text_is_all_null(spark, text):
    assert set(parse(spark, text).values()) == {None}


def test_missing_and_extra_fields(spark):
    row = parse(spark, '{"song_id":"a","extra":{"x":1}}')
    assert row.pop("song_id") == "a"
    assert set(row.values()) == {None}


@pytest.mark.parametrize("value", ['"7"', "7.5", "3000000000", "true", "[7]"])
def test_values_that_do_not_fit_an_integer(spark, value):
    row = parse(spark, f'{{"song_id":"a","duration_ms":{value}}}')
    assert (row["song_id"], row["duration_ms"]) == ("a", None)


def test_text_is_no_boolean_but_anything_is_text(spark):
    row = parse(spark, '{"explicit":"true","title":5,"song_id":["2"]}')
    assert (row["explicit"], row["title"], row["song_id"]) == (None, "5", '["2"]')


def test_rows_have_the_registered_types(spark, zone):
    song = '{"song_id":"s","title":"t","disc_number":1,"duration_ms":2,"explicit":false,' \
           '"external_url":"e","preview_url":"p","popularity":3}'
    album = '{"album_id":"a","title":"t","total_tracks":1,"release_date":"1999-05",' \
            '"external_url":"e","image_url":"i","label":"l","popularity":3}'
    artist = '{"artist_id":"r","name":"n","external_url":"e","follower_count":4,' \
             '"image_url":"i","popularity":3}'
    item = '{"song_id":"s","album_id":"a","artist_id":"r","played_at":"2024-03-10T02:30:00.125Z"}'
    wanted = {
        SONG_TOPIC: (song, ("s", "t", 1, 2, False, "e", "p", 3)),
        ALBUM_TOPIC: (album, ("a", "t", 1, date(1999, 5, 1), "e", "i", "l", 3)),
        ARTIST_TOPIC: (artist, ("r", "n", "e", 4, "i", 3)),
        ITEM_TOPIC: (item, ("s", "a", "r", datetime(2024, 3, 10, 2, 30, 0, 125000))),
    }
    for topic, (text, row) in wanted.items():
        df = parse_topic(decode(messages(spark, text, topic=topic)), topic)
        assert rows(df) == [row]
        assert df.schema == TOPICS[topic].row


def test_topics_do_not_mix(spark):
    records = messages(spark, '{"song_id":"a"}', topic=ITEM_TOPIC)
    assert parse_topic(decode(records), SONG_TOPIC).count() == 0
    assert parse_topic(decode(records), ITEM_TOPIC).count() == 1


def test_accepted_and_rejected_split_the_records(spark):
    texts = ['{"song_id":"a"}', "{bad", '{"title":"t"}', '{"song_id":null}']
    items = ['{"song_id":"b"}', "[]"]
    records = messages(spark, *texts, topic=SONG_TOPIC).unionByName(
        messages(spark, *items, topic=ITEM_TOPIC)
    )
    parsed = parse_records(decode(records))
    assert [r.song_id for r in accepted(parsed, SONG_TOPIC).collect()] == ["a"]
    assert [r.song_id for r in accepted(parsed, ITEM_TOPIC).collect()] == ["b"]
    assert bag(rejected(parsed)) == {(SONG_TOPIC, t): 1 for t in texts[1:]} | {
        (ITEM_TOPIC, "[]"): 1
    }
    for topic in TOPICS:
        rows = all_rows(parsed, topic)
        assert rows.schema == TOPICS[topic].row
        assert bag(rows) == bag(parse_topic(decode(records), topic))


def test_a_play_needs_its_song_only(spark):
    texts = ['{"song_id":"a"}', '{"album_id":"a","artist_id":"b"}']
    parsed = parse_records(decode(messages(spark, *texts, topic=ITEM_TOPIC)))
    assert accepted(parsed, ITEM_TOPIC).count() == 1
    assert rejected(parsed).count() == 1


def test_broker_options():
    assert kafka_options("h:9092") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "song_topic,album_topic,artist_topic,item_topic",
        "startingOffsets": "latest",
    }
    assert kafka_options("h:1", ["item_topic"], "earliest")["startingOffsets"] == "earliest"
    assert kafka_package().startswith("org.apache.spark:spark-sql-kafka-0-10_2.13:4.")
    assert KafkaTopics("h:1").topics == tuple(TOPICS)


def test_folder_topics_replace_a_repeated_batch(spark, tmp_path):
    topics = FolderTopics(str(tmp_path / "topics"))
    topics.append(messages(spark, "1", "2", topic=SONG_TOPIC), "q.0")
    topics.append(messages(spark, "3", topic=SONG_TOPIC), "q.1")
    topics.append(messages(spark, "4", topic=SONG_TOPIC), "q.0")
    assert sorted(bytes(r.value) for r in topics.read(spark).collect()) == [b"3", b"4"]


def test_broker_settings_and_bound():
    topics = KafkaTopics("h:1", extra={"kafka.security.protocol": "SSL", "failOnDataLoss": "false"}, max_offsets=7)
    read, write = topics.read_options(), topics.write_options()
    assert read["maxOffsetsPerTrigger"] == "7" and read["failOnDataLoss"] == "false"
    assert read["kafka.security.protocol"] == write["kafka.security.protocol"] == "SSL"
    assert set(write) == {"kafka.bootstrap.servers", "kafka.security.protocol"}
    assert "maxOffsetsPerTrigger" not in KafkaTopics("h:1").read_options()


@pytest.mark.parametrize("bound", [{"max_files": 1}, {"max_bytes": 1}])
def test_a_bounded_folder_is_read_in_several_batches_to_its_end(spark, tmp_path, bound):
    for n in range(3):
        FolderTopics(str(tmp_path / "t")).append(messages(spark, f"{n}", topic=SONG_TOPIC), str(n))
    sizes = []
    stream = FolderTopics(str(tmp_path / "t"), **bound).read_stream(spark)
    query = (
        stream.writeStream.foreachBatch(lambda df, _: sizes.append(df.count()))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sum(sizes) == 3 and len(sizes) >= 3
