"""Landing folders: raw history pages and raw entity details."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader

from playledger.schemas import HISTORY_PAYLOAD


@dataclass(frozen=True)
class Entities:
    """Raw details of songs, albums and artists: ``(<key>, payload, fetched_at)``."""

    song: DataFrame
    album: DataFrame
    artist: DataFrame

    def raw(self, key: str) -> DataFrame:
        """The landing table of the entities that ``key`` identifies."""
        return {"song_id": self.song, "album_id": self.album, "artist_id": self.artist}[key]


def read_entities(spark: SparkSession, root: str) -> Entities:
    """Entity landing tables (Parquet) below ``root``: ``song``, ``album`` and ``artist``."""

    def table(name: str) -> DataFrame:
        schema = f"{name}_id STRING, payload STRING, fetched_at TIMESTAMP_NTZ"
        return spark.read.schema(schema).parquet(f"{root}/{name}")

    return Entities(table("song"), table("album"), table("artist"))


def bounded(
    reader: DataStreamReader, max_files: int | None, max_bytes: int | None
) -> DataStreamReader:
    """The reader with a bound per batch, in bytes or else in files. What is beyond it comes in the
    next batches."""
    if max_bytes:
        return reader.option("maxBytesPerTrigger", max_bytes)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def stream_pages(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Raw history pages as a stream; the checkpoint of its query is the poll cursor.

    ``archive``: a folder outside of ``path``, to which files move once their batch is committed, so
    that the folder that each batch has to list stays small.
    """
    reader = bounded(spark.readStream.schema(HISTORY_PAYLOAD), max_files, max_bytes)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)
