"""What several operators share: words, hashes of ids, tables in the shared folder."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.sources.scratch import shared_folder

#: White space between words, as a pattern of Java and Python: space, tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text in order, as an array; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read back.

    Cuts the lineage: what was computed is neither computed again nor lost with an executor.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Slots of a table of bits that rules out rows before a join; one bit each.
SLOTS = 1 << 23


def slot(*keys: str | Column) -> Column:
    """The slot of a row, by its keys."""
    return F.pmod(F.xxhash64(*keys, F.lit(11)), F.lit(SLOTS))


def taken_slots(slots: DataFrame) -> np.ndarray:
    """A bit for each slot, set for those in ``slots`` (``slot``). Its size is fixed: the more keys, the more others share a slot, so a join is to decide.

    Rows that it rules out need not move, even where the keys are too many to be broadcast.
    """
    # Spark's buckets count from 1, and have 32768 places each, so at most SLOTS / 32768 rows come back.
    buckets = slots.select((F.col("slot") + 1).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
    table = np.zeros(SLOTS, np.uint8)
    for row in buckets.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect():
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        table[(row["bucket"] - 1) * len(bits) :][: len(bits)] = bits
    return np.packbits(table)


def is_taken(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (table[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1


_HELD: dict[str, Any] = {}


def process_cache(owner: str, make: Callable[[], Any]) -> Any:
    """What ``owner`` remembers in this process, made on first use.

    Spark's Python workers go on from task to task and from stage to stage. What one operator has remembered goes
    when another one asks, so that a worker never holds the memory of several.
    """
    if owner not in _HELD:
        _HELD.clear()
        gc.collect()
        _HELD[owner] = make()
    return _HELD[owner]


def hand_back() -> None:
    """Memory that is free, but kept by the allocators of this process, goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which hands memory back at the end of its task.

    Spark keeps Python workers that wait for a task, more of them than an executor has cores. What each has held for its
    last task would else stand beside the memory of all steps that follow.
    """

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            hand_back()

    return task


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
