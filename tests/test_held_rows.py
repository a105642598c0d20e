"""Rows that are used more than once are held on disk, not in the memory of one task."""

import importlib

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from playledger.operators.messages import decode, parse_records
from playledger.schemas import ITEM_TOPIC, SONG_TABLE, SONG_TOPIC
from playledger.sources import REJECTS_TABLE, FolderTopics, FolderWarehouse
from playledger.sources.scratch import drop_folder, held
from playledger.streaming import dispatch
from playledger.testbed import queries
from tests.util import bag, messages, plan

DATA = "/root/testdata/sf0.001"


def test_plays_that_are_routed_are_held_on_disk(spark):
    found = queries.QUERIES["route_topics"](spark, DATA)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("StorageLevel(disk, 1 replicas)") and "memory" not in text
    spark.catalog.clearCache()


def test_batches_that_are_compacted_come_from_one_parse(spark, monkeypatch):
    held = []
    monkeypatch.setattr(FolderWarehouse, "append", lambda self, rows, table, batch: held.append((batch, rows.storageLevel)))
    monkeypatch.setattr(FolderWarehouse, "compact", lambda self, spark, table: None)
    monkeypatch.setattr(queries, "_table_counts", lambda *_: None)
    queries.QUERIES["compaction_roundtrip"](spark, DATA)
    assert len(held) == 4 * 9 + 1
    assert all(level.useDisk and not level.useMemory for _, level in held[:-1])


TEXTS = ('{"song_id":"s1","title":"One"}', '{"song_id":"s1","title":"Uno"}', "{bad", '{"title":"no key"}')


def _dispatched(spark, path):
    topics = FolderTopics(f"{path}/topics")
    topics.append(messages(spark, *TEXTS, topic=SONG_TOPIC), "1")
    warehouse = FolderWarehouse(f"{path}/warehouse")
    dispatch(topics.read_stream(spark), warehouse, f"{path}/checkpoint", {"availableNow": True}).awaitTermination()
    return warehouse


def test_records_of_a_batch_are_held_in_files_until_its_tables_are_written(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(FolderWarehouse, "append", lambda self, rows, table, batch: seen.append((table, plan(rows), rows.inputFiles())))
    _dispatched(spark, tmp_path)
    assert [table for table, _, _ in seen] == [SONG_TABLE, REJECTS_TABLE]
    for _, text, files in seen:
        assert "InMemoryTableScan" not in text and "from_json" not in text
        assert files and all("/checkpoint/parsed/" in name for name in files)
    assert not (tmp_path / "checkpoint" / "parsed").exists()


def test_held_records_go_when_a_batch_fails_and_it_is_repeated(spark, tmp_path, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(FolderWarehouse, "append", lambda self, rows, table, batch: 1 / 0)
        with pytest.raises(StreamingQueryException):
            _dispatched(spark, tmp_path)
    assert not (tmp_path / "checkpoint" / "parsed").exists()
    warehouse = _dispatched(spark, tmp_path)
    assert bag(warehouse.read(spark, SONG_TABLE).select("song_id", "title")) == {("s1", "Uno"): 1}
    rejects = warehouse.batches(spark, REJECTS_TABLE)
    assert bag(rejects.select("json_value")) == {(text,): 1 for text in TEXTS[2:]}
    assert rejects.filter("origin IS NOT NULL").select("origin").distinct().count() == 2


def test_held_rows_are_the_rows(spark, tmp_path):
    odd = spark.createDataFrame([(b"\xff\xfe", SONG_TOPIC), (b"", ITEM_TOPIC), (None, SONG_TOPIC), (None, None)], "value binary, topic string")
    parsed = parse_records(decode(messages(spark, *TEXTS, *TEXTS, topic=SONG_TOPIC).unionByName(odd)))
    path = str(tmp_path / "rows")
    for rows in (parsed.limit(0), parsed):  # the second in place of the first
        found = held(rows, path)
        assert found.schema == rows.schema
        text = [F.hex(F.col("json_value").cast("binary")).alias("json_value"), *[c for c in rows.columns if c != "json_value"]]
        assert bag(found.select(*text)) == bag(rows.select(*text))
    drop_folder(spark, path)
    drop_folder(spark, path)
    assert not (tmp_path / "rows").exists()


@pytest.mark.parametrize("most, joined", [(1, "SortMergeJoin"), (100, "BroadcastHashJoin")])
def test_keys_of_many_records_are_not_broadcast(spark, tmp_path, monkeypatch, most, joined):
    _dispatched(spark, tmp_path)
    monkeypatch.setattr(importlib.import_module("playledger.streaming.dispatch"), "MANY_RECORDS", most)
    warehouse, seen = FolderWarehouse(f"{tmp_path}/warehouse"), []
    append = FolderWarehouse.append

    def seen_append(self, rows, table, batch):
        if table == SONG_TABLE:
            seen.append(plan(rows))
        append(self, rows, table, batch)

    monkeypatch.setattr(FolderWarehouse, "append", seen_append)
    topics = FolderTopics(f"{tmp_path}/topics")
    topics.append(messages(spark, '{"song_id":"s1","title":"Zzz"}', '{"song_id":"s2"}', topic=SONG_TOPIC), "2")
    dispatch(topics.read_stream(spark), warehouse, f"{tmp_path}/checkpoint", {"availableNow": True}).awaitTermination()
    (text,) = seen
    assert [line.split("+- ")[-1].split()[0] for line in text.splitlines() if "LeftSemi" in line] == [joined]
    assert bag(warehouse.read(spark, SONG_TABLE).select("song_id", "title")) == {("s1", "Uno"): 1, ("s2", None): 1}
