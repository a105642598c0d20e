"""Warehouse tables: Parquet folders, or a database over JDBC.

Both kinds offer ``read``, ``star``, ``dimensions``, ``known_keys``, ``append`` and ``compact``. ``batch``
names one micro-batch of one stream and is the same when that batch is replayed. By default every
row of a batch is appended; with ``idempotent`` plays that are equal in all columns count once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from playledger.operators.listening import PLAY_DATE, PLAYS, WEEK, count_plays
from playledger.schemas import (
    ALBUM_TABLE,
    ARTIST_TABLE,
    FACT_TABLE,
    SONG_TABLE,
    STRING,
    TABLES,
    struct,
)
from playledger.star import Dimensions, Star

REJECTS_TABLE = "rejects"
#: Plays counted by day, week and ids, as a folder warehouse can keep them beside the plays.
COUNTS_TABLE = "play_counts"
_REJECTS = struct(topic=STRING, json_value=STRING)
#: Origins of the rejects that were mended and taken in.
MENDED_TABLE = "mended"
_MENDED = struct(topic=STRING, origin=STRING)


def table_schema(table: str) -> T.StructType:
    return {REJECTS_TABLE: _REJECTS, MENDED_TABLE: _MENDED}.get(table) or TABLES[table].row


def _stored_schema(table: str) -> T.StructType:
    """Schema of the files of a folder: rejects also keep where they come from, plays their day, and all their batch."""
    schema = T.StructType(list(table_schema(table)))
    if table == REJECTS_TABLE:
        schema = schema.add("origin", STRING)
    if table == FACT_TABLE:
        schema = schema.add(PLAY_DATE, T.DateType())
    return schema.add("batch", STRING)


class MissingTable(LookupError):
    """The warehouse does not hold a table that has to be there."""


class _Warehouse:
    #: Plays that are equal in all columns to a stored one, or to one of the same batch, are dropped.
    idempotent: bool

    def read(self, spark: SparkSession, table: str, missing_ok: bool = False) -> DataFrame:
        raise NotImplementedError

    def star(self, spark: SparkSession) -> Star:
        """The four tables as a star. There has to be a table of plays; details may still be missing."""
        dims = self.dimensions(spark)
        return Star(self.read(spark, FACT_TABLE), dims.song, dims.album, dims.artist)

    def dimensions(self, spark: SparkSession) -> Dimensions:
        """The tables of songs, albums and artists; those that do not exist yet are empty. The plays
        are not opened."""
        return Dimensions(
            *[self.read(spark, t, missing_ok=True) for t in (SONG_TABLE, ALBUM_TABLE, ARTIST_TABLE)]
        )

    def compact(self, spark: SparkSession, table: str) -> None:
        """Merges small pieces of the table, if it consists of such."""

    def _to_append(self, rows: DataFrame, stored: Callable[[], DataFrame], table: str) -> DataFrame:
        """The rows of a batch that are to be written: by default all of them."""
        return unseen_plays(rows, stored()) if self.idempotent and table == FACT_TABLE else rows


@dataclass(frozen=True)
class FolderWarehouse(_Warehouse):
    """Parquet tables below a shared folder.

    Each batch has its own partition, which a replay overwrites: every batch counts exactly once.
    The fact table is partitioned by play date first, so that a weekly recap reads its own days.

    ``compact`` merges batches. What a table consists of is then listed by the newest version of its
    manifest, below ``manifest``: folders of merged rows, and the live folder, which holds the batches
    since. Without a manifest the live folder is that of the table.
    """

    root: str
    idempotent: bool = False
    #: Folders of merged rows that are merged again once there are more of them.
    merged_folders: int = 8
    #: Each batch of plays is also counted, in a partition of its own; ``counted_star`` then answers recaps without the plays.
    keep_counts: bool = False

    def _manifest(self, spark: SparkSession, table: str) -> tuple[int, list[str], str]:
        """Version, folders of merged rows, live folder."""
        schema = "version INT, folder STRING, live BOOLEAN"
        try:
            rows = spark.read.schema(schema).parquet(f"{self.root}/manifest/{table}").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        if not rows:
            return 0, [], table
        version = max(r["version"] for r in rows)
        newest = [r for r in rows if r["version"] == version]
        merged = sorted(r["folder"] for r in newest if not r["live"])
        return version, merged, next(r["folder"] for r in newest if r["live"])

    def _folder(self, spark: SparkSession, table: str, folder: str) -> DataFrame | None:
        """Rows of one folder with their ``batch``, or None if it does not exist."""
        try:
            return spark.read.schema(_stored_schema(table)).parquet(f"{self.root}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _stored(self, spark: SparkSession, table: str, missing_ok: bool = True) -> DataFrame:
        _, merged, live = self._manifest(spark, table)
        parts = [self._folder(spark, table, folder) for folder in (*merged, live)]
        parts = [part for part in parts if part is not None]
        if parts:
            return reduce(DataFrame.unionByName, parts)
        if not missing_ok:
            raise MissingTable(f"there is no table {table!r} below {self.root!r}")
        # Known to be empty when a query is planned, so that joins with it fall away.
        return spark.range(1).limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _stored_schema(table)])

    def read(self, spark: SparkSession, table: str, missing_ok: bool = False) -> DataFrame:
        """Rows of the table; the fact table also has its partition column ``play_date``."""
        more = [PLAY_DATE] if table == FACT_TABLE else []
        return self._stored(spark, table, missing_ok).select(*table_schema(table).names, *more)

    def batches(self, spark: SparkSession, table: str) -> DataFrame:
        """Rows of the table with the batch that wrote them, rejects also with their ``origin``."""
        return self._stored(spark, table)

    def known_keys(self, spark: SparkSession, table: str, batch: str) -> DataFrame:
        """Keys in the table, but for those that an earlier run of the same batch wrote."""
        stored = self._stored(spark, table).filter(F.col("batch") != batch)
        return stored.select(TABLES[table].key)

    def append(self, rows: DataFrame, table: str, batch: str) -> None:
        """Write the batch, in place of an earlier run of it."""
        spark = rows.sparkSession
        rows = self._to_append(
            rows, lambda: self._stored(spark, table).filter(F.col("batch") != batch), table
        )
        live = self._manifest(spark, table)[2]
        self._write(rows.withColumn("batch", F.lit(batch)), table, live)
        if self.keep_counts and table == FACT_TABLE:
            self._count(spark, live, batch)

    def _count(self, spark: SparkSession, live: str, batch: str) -> None:
        """Counts what the batch has written, in place of the counts of an earlier run of it."""
        written = self._folder(spark, FACT_TABLE, live)
        assert written is not None
        counts = count_plays(written.filter(F.col("batch") == batch)).withColumn("batch", F.lit(batch))
        (
            counts.hint("rebalance", PLAY_DATE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PLAY_DATE, "batch")
            .parquet(f"{self.root}/{COUNTS_TABLE}")
        )

    def counted_star(self, spark: SparkSession) -> Star:
        """The star with counted plays in place of the plays: the recaps are the same, and read days and counts only."""
        fact = T.StructType([f for f in table_schema(FACT_TABLE) if f.name != "played_at"])
        schema = fact.add(WEEK, T.DateType()).add(PLAYS, T.LongType()).add("played_at", T.TimestampNTZType())
        schema = schema.add(PLAY_DATE, T.DateType()).add("batch", T.StringType())
        try:
            counts = spark.read.schema(schema).parquet(f"{self.root}/{COUNTS_TABLE}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise MissingTable(f"there is no table {COUNTS_TABLE!r} below {self.root!r}") from None
        dims = self.dimensions(spark)
        return Star(counts.drop("batch"), dims.song, dims.album, dims.artist)

    def _write(self, rows: DataFrame, table: str, folder: str) -> None:
        """Plays are rebalanced by date: few files, and a date with many plays is split over several
        tasks."""
        partitions = ["batch"]
        if table == FACT_TABLE:
            rows = rows.withColumn(PLAY_DATE, F.col("played_at").cast("date"))
            rows = rows.hint("rebalance", PLAY_DATE)
            partitions = [PLAY_DATE, "batch"]
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(f"{self.root}/{folder}")
        )

    def compact(self, spark: SparkSession, table: str) -> None:
        """Merges the committed batches of the live folder into a folder of merged rows.

        The newest batch of each stream may be replayed, so it is carried over to the new live folder
        under its name. Both folders are written aside and count only when the manifest lists them,
        with one file; a run that ends before leaves all as it was. Old folders are left for readers that have
        opened them, and may be deleted later. No write to the table may run meanwhile.
        """
        version, merged, live = self._manifest(spark, table)
        stored = self._folder(spark, table, live)
        if stored is None:
            return
        # One row per batch since the last run.
        batches = [r["batch"] for r in stored.select("batch").distinct().collect()]
        newest = _newest_batches(batches)
        if len(batches) - len(newest) < 2:
            return
        rows = [stored.filter(~F.col("batch").isin(newest))]
        if len(merged) >= self.merged_folders:
            rows += [self._folder(spark, table, folder) for folder in merged]
            merged = []
        made, next_live = (f"{kind}/{table}/{uuid.uuid4().hex}" for kind in ("merged", "live"))
        together = reduce(DataFrame.unionByName, rows).withColumn("batch", F.lit(_MERGED))
        self._write(together.drop(PLAY_DATE), table, made)
        self._write(stored.filter(F.col("batch").isin(newest)).drop(PLAY_DATE), table, next_live)
        listed = [(version + 1, f, False) for f in (*merged, made)] + [(version + 1, next_live, True)]
        (
            spark.createDataFrame(listed, "version INT, folder STRING, live BOOLEAN")
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.root}/manifest/{table}")
        )


_MERGED = "merged"


def _newest_batches(batches: list[str]) -> list[str]:
    """The last batch of each stream; a name without a number is a stream of its own."""
    newest: dict[str, tuple[int, str]] = {}
    for tag in batches:
        stream, _, number = tag.rpartition(".")
        key = (stream, int(number)) if number.isdigit() else (tag, 0)
        newest[key[0]] = max(newest.get(key[0], (-1, "")), (key[1], tag))
    return sorted(tag for _, tag in newest.values())


@dataclass(frozen=True)
class JdbcWarehouse(_Warehouse):
    """Tables in a database, which have to exist.

    ``options`` are those of Spark's JDBC source without ``dbtable`` (url, driver, user, password,
    batchsize, ...). ``read_options`` adds options per table for parallel reads (partitionColumn,
    lowerBound, upperBound, numPartitions). The plays are only read with such options, as one
    connection would read them all.

    The tables have no batch column, so a replayed batch is appended again unless ``idempotent`` is set.
    """

    options: dict[str, str]
    read_options: dict[str, dict[str, str]] = field(default_factory=dict)
    idempotent: bool = False

    def table_options(self, table: str) -> dict[str, str]:
        return self.options | {"dbtable": table}

    def read(self, spark: SparkSession, table: str, missing_ok: bool = False) -> DataFrame:
        """Rows of the table; timestamps are read as the wall-clock values they are stored as."""
        more = self.read_options.get(table, {})
        if table == FACT_TABLE and "partitionColumn" not in more:
            raise ValueError(f"give read options with a partitionColumn for {table!r}")
        options = {"preferTimestampNTZ": "true"} | self.table_options(table) | more
        return spark.read.format("jdbc").options(**options).load()

    def known_keys(self, spark: SparkSession, table: str, batch: str) -> DataFrame:
        return self.read(spark, table).select(TABLES[table].key)

    def append(self, rows: DataFrame, table: str, batch: str) -> None:
        if table == REJECTS_TABLE:  # its table has no column for the origin
            rows = rows.select(*_REJECTS.names)
        rows = self._to_append(rows, lambda: self.read(rows.sparkSession, table), table)
        rows.write.format("jdbc").options(**self.table_options(table)).mode("append").save()


def unseen_plays(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct plays of the batch that are not stored yet, NULLs matching NULLs.

    Of the stored plays only those of the play dates that occur in the batch are compared.
    """
    columns = TABLES[FACT_TABLE].row.names
    rows = rows.dropDuplicates(columns)
    days = rows.select(F.col("played_at").cast("date").alias("day")).distinct()
    day = F.col(PLAY_DATE) if PLAY_DATE in stored.columns else F.col("played_at").cast("date")
    old = stored.join(days, day.eqNullSafe(F.col("day")), "left_semi")
    old = old.select(*[F.col(c).alias(f"old_{c}") for c in columns])
    same = [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in columns]
    return rows.join(old, same, "left_anti")
