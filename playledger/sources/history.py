"""The play history service as a data source, read by a cursor of its own.

Offsets are epoch milliseconds. A batch holds the plays after its start and up to its end, so a query that is restarted goes on strictly
after the last play of its last committed batch. The span of a batch is split into time ranges, each read by one task, as Arrow batches.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from playledger.operators.listening import PLAY_MS

FORMAT = "play_history"
SCHEMA = "played_at string, song_id string, album_id string, artist_id string"
_COLUMNS = ["played_at", "song_id", "album_id", "artist_id"]
_ARROW = pa.schema([(name, pa.string()) for name in _COLUMNS])
#: Longest time range of a task, unless the span has more than ``MOST_RANGES`` of them.
RANGE_MS = 3_600_000
MOST_RANGES = 1000


class HistoryService(Protocol):
    """What the source asks of a service; the driver asks for the times, tasks for plays."""

    def times(self) -> tuple[int, int] | None:
        """Times of the oldest and the newest play in epoch milliseconds, None without plays."""

    def plays(self, after: int, until: int) -> Iterator[pa.RecordBatch]:
        """Plays with ``after < time <= until``: ``played_at, song_id, album_id, artist_id``."""


class TableService:
    """Plays in Parquet files, with their time in ``played_ms``. The filter reaches the row groups.

    ``path``: a folder, or a URI that Arrow can open. What has no time is not part of the history.
    """

    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"]

    def _dataset(self):
        import pyarrow.dataset as ds

        return ds.dataset(self.path, format="parquet")

    def times(self) -> tuple[int, int] | None:
        """From the statistics in the footers."""
        groups = [g.statistics or {} for f in self._dataset().get_fragments() for g in f.row_groups]
        found = [g[PLAY_MS] for g in groups if PLAY_MS in g]
        return (min(x["min"] for x in found), max(x["max"] for x in found)) if found else None

    def plays(self, after: int, until: int) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        wanted = (ds.field(PLAY_MS) > after) & (ds.field(PLAY_MS) <= until)
        for batch in self._dataset().to_batches(columns=_COLUMNS, filter=wanted):
            if len(batch):
                yield batch.cast(_ARROW)


def _service(options: Mapping[str, str]) -> HistoryService:
    """The service named ``module:Class`` by the option ``service``; by default files at ``path``."""
    module, _, name = options.get("service", f"{__name__}:TableService").partition(":")
    return getattr(importlib.import_module(module), name)(options)


@dataclass
class TimeRange(InputPartition):
    after: int
    until: int


def time_ranges(after: int, until: int, width: int = RANGE_MS) -> list[TimeRange]:
    """Ranges that cover ``(after, until]``, none overlapping another; wider ones for a very long span."""
    width = max(width, -(-(until - after) // MOST_RANGES))
    return [TimeRange(at, min(at + width, until)) for at in range(after, until, width)]


class _Options:
    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = dict(options)
        self.width = int(options.get("range_ms", RANGE_MS))
        if self.width < 1:
            raise ValueError("range_ms has to be positive")

    def newest(self) -> int:
        """Without plays, nothing lies after any start."""
        times = _service(self.options).times()
        return times[1] if times else 0

    def ranges(self, after: int, until: int) -> list[TimeRange]:
        """The ranges of a batch; a cursor from before the first play is moved up to it."""
        times = _service(self.options).times()
        return time_ranges(max(after, times[0] - 1), until, self.width) if times else []

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        assert isinstance(partition, TimeRange)
        return _service(self.options).plays(partition.after, partition.until)


class HistoryStream(_Options, DataSourceStreamReader):
    """The stream. ``after``: where a new query begins, by default now; an existing one goes on at its checkpoint.

    The newest offset is never below ``after``, so that a history that only has older plays does not move the cursor back.
    """

    def __init__(self, options: Mapping[str, str]) -> None:
        super().__init__(options)
        self.after = int(self.options.get("after", time.time() * 1000))

    def initialOffset(self) -> dict[str, Any]:
        return {"ms": self.after}

    def latestOffset(self) -> dict[str, Any]:
        return {"ms": max(self.newest(), self.after)}

    def partitions(self, start: dict[str, Any], end: dict[str, Any]) -> list[TimeRange]:
        if end["ms"] < start["ms"]:
            # Committing such a batch would read plays again.
            raise ValueError(f"the history ends at {end['ms']}, before the cursor; start with after={start['ms']}")
        return self.ranges(start["ms"], end["ms"])


class HistoryBatch(_Options, DataSourceReader):
    """All plays ``after`` and ``until`` the given times, by default all that there are."""

    def partitions(self) -> list[TimeRange]:
        until = int(self.options.get("until", self.newest()))
        return self.ranges(int(self.options.get("after", 0)), until) or [TimeRange(0, 0)]


class HistorySource(DataSource):
    """The data source; register it with ``register``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: Any) -> HistoryStream:
        return HistoryStream(self.options)

    def reader(self, schema: Any) -> HistoryBatch:
        return HistoryBatch(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format ``play_history`` known to the session."""
    spark.dataSource.register(HistorySource)


def stream_history(spark: SparkSession, path: str, after: int | None = None, **options: str) -> DataFrame:
    """Plays of the service as a stream. A play that the service learns of only after a newer one was read is not seen, as
    with any cursor over play times; read with an earlier ``after`` and drop copies where that happens."""
    register(spark)
    reader = spark.readStream.format(FORMAT).option("path", path).options(**options)
    return (reader.option("after", after) if after is not None else reader).load()
