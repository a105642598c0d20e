from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql.classic.dataframe import DataFrame

from playledger.schemas import FACT_TABLE, SONG_TABLE, TABLES
from playledger.sources import (
    FolderWarehouse,
    JdbcWarehouse,
    MissingTable,
    shared_folder,
    unseen_plays,
)
from playledger.streaming.dispatch import new_rows
from tests.util import bag, plan

PLAY = "song_id string, album_id string, artist_id string, played_at timestamp_ntz"
T1, T2, T3 = (datetime(2024, 7, d) for d in (1, 2, 3))


def test_missing_tables_are_empty_if_that_is_asked_for(spark, tmp_path):
    warehouse = FolderWarehouse(str(tmp_path / "none"))
    for name, topic in TABLES.items():
        stored = warehouse.read(spark, name, missing_ok=True).drop("play_date")
        assert stored.schema == topic.row
        assert stored.count() == 0
    assert warehouse.known_keys(spark, SONG_TABLE, "q.0").count() == 0
    assert warehouse.dimensions(spark).artist.count() == 0


def test_rows_are_made_once_when_no_key_is_known(spark, tmp_path):
    """The first batch of a table: the join with its known keys falls away, and the rows are not computed a second time for it."""
    rows = spark.createDataFrame([("s1",) + (None,) * 7, ("s1",) + (None,) * 7, ("s2",) + (None,) * 7], TABLES[SONG_TABLE].row)
    rows.write.parquet(str(tmp_path / "songs_in"))
    found = new_rows(spark.read.parquet(str(tmp_path / "songs_in")), "song_id", FolderWarehouse(str(tmp_path / "none")).known_keys(spark, SONG_TABLE, "q.0"))
    assert "Join" not in plan(found) and plan(found).count("songs_in") == 1
    assert bag(found.select("song_id")) == {("s1",): 1, ("s2",): 1}


def test_a_star_without_plays_is_an_error(spark, tmp_path):
    with pytest.raises(MissingTable, match="fact_history.*none"):
        FolderWarehouse(str(tmp_path / "none")).star(spark)


def test_dimensions_do_not_open_the_plays(spark, tmp_path):
    warehouse = FolderWarehouse(str(tmp_path))
    rows = spark.createDataFrame([("s1",) + (None,) * 7], TABLES[SONG_TABLE].row)
    warehouse.append(rows, SONG_TABLE, "q.0")
    dims = warehouse.dimensions(spark)
    assert dims.song.count() == 1
    assert "fact_history" not in plan(dims.song)


def _songs(spark, *ids):
    return spark.createDataFrame([(i,) + (None,) * 7 for i in ids], TABLES[SONG_TABLE].row)


def _ids(spark, warehouse):
    return bag(warehouse.read(spark, SONG_TABLE).select("song_id"))


def test_compaction_keeps_rows_once_and_the_newest_batch_replayable(spark, tmp_path):
    warehouse = FolderWarehouse(str(tmp_path), merged_folders=1)
    wanted = {}
    for n in range(6):
        warehouse.append(_songs(spark, f"s{n}", f"s{n}"), SONG_TABLE, f"q.{n}")
        wanted[(f"s{n}",)] = 2
        if n % 2:
            warehouse.compact(spark, SONG_TABLE)
            warehouse.append(_songs(spark, f"s{n}", f"s{n}"), SONG_TABLE, f"q.{n}")
        assert _ids(spark, warehouse) == wanted
    assert ("s5",) not in bag(warehouse.known_keys(spark, SONG_TABLE, "q.5"))


def test_a_compaction_that_ends_early_changes_nothing(spark, tmp_path, monkeypatch):
    warehouse = FolderWarehouse(str(tmp_path))
    for n in range(4):
        warehouse.append(_songs(spark, f"s{n}"), SONG_TABLE, f"q.{n}")
    before = _ids(spark, warehouse)
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "coalesce", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            warehouse.compact(spark, SONG_TABLE)
    assert _ids(spark, warehouse) == before
    warehouse.compact(spark, SONG_TABLE)
    assert _ids(spark, warehouse) == before


def test_compacted_plays_keep_their_dates(spark, tmp_path):
    warehouse = FolderWarehouse(str(tmp_path))
    for n, when in enumerate((T1, T2, None, T3)):
        warehouse.append(spark.createDataFrame([("s", "a", "r", when)], PLAY), FACT_TABLE, f"q.{n}")
    before = bag(warehouse.read(spark, FACT_TABLE))
    warehouse.compact(spark, FACT_TABLE)
    after = warehouse.read(spark, FACT_TABLE)
    assert bag(after) == before
    assert "play_date" in plan(after.where("play_date = DATE'2024-07-02'")).split("PartitionFilters")[1]


@pytest.mark.parametrize("idempotent, wanted", [(False, 4), (True, 2)])
def test_both_sinks_follow_one_rule(spark, tmp_path, monkeypatch, idempotent, wanted):
    """Equal plays in one batch and in the next one; of the database, what would be written."""
    folder = FolderWarehouse(str(tmp_path), idempotent)
    database = JdbcWarehouse({"url": "jdbc:x"}, idempotent=idempotent)
    written = spark.createDataFrame([], PLAY)
    batches = [[("s", "a", "r", T1)] * 2, [("s", "a", "r", T1), ("s", "a", "r", T2)]]
    for n, batch in enumerate(batches):
        rows, saved = spark.createDataFrame(batch, PLAY), []
        folder.append(rows, FACT_TABLE, f"q.{n}")
        with monkeypatch.context() as m:
            m.setattr(JdbcWarehouse, "read", lambda self, spark, table, stored=written: stored)
            m.setattr(DataFrameWriter, "save", lambda self: saved.append(self._df))
            database.append(rows, FACT_TABLE, f"q.{n}")
        written = written.union(saved[0])
    assert bag(folder.read(spark, FACT_TABLE).drop("play_date")) == bag(written)
    assert written.count() == wanted


def test_plays_in_a_database_need_a_parallel_read(spark):
    with pytest.raises(ValueError, match="partitionColumn"):
        JdbcWarehouse({"url": "jdbc:x"}).read(spark, FACT_TABLE)


def test_known_keys_leave_out_the_batch_itself(spark, tmp_path):
    warehouse = FolderWarehouse(str(tmp_path))
    row = (None,) * 7
    schema = TABLES[SONG_TABLE].row
    warehouse.append(spark.createDataFrame([("s1", *row)], schema), SONG_TABLE, "q.0")
    warehouse.append(spark.createDataFrame([("s2", *row)], schema), SONG_TABLE, "q.1")
    assert bag(warehouse.known_keys(spark, SONG_TABLE, "q.1")) == {("s1",): 1}
    assert bag(warehouse.known_keys(spark, SONG_TABLE, "q.2")) == {("s1",): 1, ("s2",): 1}


def test_plays_without_a_time_are_kept(spark, tmp_path):
    warehouse = FolderWarehouse(str(tmp_path))
    plays = spark.createDataFrame([("s", "a", "r", None), ("s", "a", "r", T1)], PLAY)
    warehouse.append(plays, FACT_TABLE, "q.0")
    assert bag(warehouse.read(spark, FACT_TABLE).drop("play_date")) == bag(plays)


@pytest.mark.parametrize("stored", [[], [("s", "a", "r", T1), ("s", None, "r", None), ("x", "a", "r", T3)]])
def test_unseen_plays(spark, stored):
    rows = spark.createDataFrame(
        [("s", "a", "r", T1), ("s", "a", "r", T2), ("s", "a", "r", T2), ("s", None, "r", None),
         ("x", "a", "r", T1)],
        PLAY,
    )
    found = bag(unseen_plays(rows, spark.createDataFrame(stored, PLAY)))
    new = {("s", "a", "r", T2): 1, ("x", "a", "r", T1): 1}
    old = {("s", "a", "r", T1): 1, ("s", None, "r", None): 1}
    assert found == (new if stored else new | old)


def test_unseen_plays_of_a_batch_without_times(spark):
    rows = spark.createDataFrame([("s", "a", "r", None)], PLAY)
    assert bag(unseen_plays(rows, rows)) == {}
    assert bag(unseen_plays(rows, rows.limit(0))) == {("s", "a", "r", None): 1}


def test_database_options():
    warehouse = JdbcWarehouse({"url": "jdbc:x", "driver": "d", "user": "u", "password": "p"})
    assert warehouse.table_options(SONG_TABLE) == {
        "url": "jdbc:x", "driver": "d", "user": "u", "password": "p", "dbtable": "dim_song",
    }


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two and one.startswith(f"{root}/x-")


@pytest.mark.parametrize("idempotent, wanted", [(True, 1), (False, 2)])
def test_database_append_leaves_out_stored_plays(spark, monkeypatch, idempotent, wanted):
    """What would be written; no database takes part."""
    stored = spark.createDataFrame([("s", "a", "r", T1)], PLAY)
    written = []
    monkeypatch.setattr(JdbcWarehouse, "read", lambda self, spark, table: stored)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: written.append(self._df))
    warehouse = JdbcWarehouse({"url": "jdbc:x"}, idempotent=idempotent)
    rows = spark.createDataFrame([("s", "a", "r", T1), ("s", "a", "r", T2)], PLAY)
    warehouse.append(rows, FACT_TABLE, "q.0")
    assert written[0].count() == wanted
    assert bag(warehouse.known_keys(spark, FACT_TABLE, "q.0")) == {("s",): 1}
