"""Packing documents into training sequences as a cutting-stock problem.

Documents are tokenised and cut into pieces of at most half a sequence. The lengths of the pieces, rounded up
to a grid, form a histogram of bounded size. A linear program over patterns (how many pieces of each length make up one
sequence) is solved by column generation: the duals of the current patterns price new ones, which a
knapsack dynamic program finds. The pattern counts are rounded down; what is left is filled greedily, largest
first. Pieces are then ranked within their length, and the ranks select places in the patterns.

Only the histogram, of one number per length class, comes to the driver. Its size and that of the patterns depend on the sequence
length and the grid, not on the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playledger.llm import bpe
from playledger.llm.common import stored, thrifty

#: The id that ends each document.
END_ID = 1


@dataclass(frozen=True)
class Shape:
    """Tokens of a sequence, of the longest piece, and of the grid to which lengths are rounded for planning."""

    capacity: int = 2048
    piece: int = 1024
    grid: int = 8

    @property
    def units(self) -> int:
        return self.capacity // self.grid


_PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, cls int, task int, nth long, ids binary"
)


def pieces(docs: DataFrame, shape: Shape, tokenizer: str = bpe.TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Documents (``doc_id, text``) cut into pieces, written to the shared folder.

    ``cls`` is the length in grid steps; ``nth`` counts the pieces of a class within the task that wrote them, so that a
    rank over all tasks needs no sort and no window over a class. ``ids`` are unsigned 32-bit little-endian, null unless asked for.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.tokenizer(tokenizer)
        task = TaskContext.get().partitionId()
        seen = np.zeros(shape.units + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.encode(text.as_py()), np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), shape.piece):
                    raw = ids[start : start + shape.piece].tobytes()
                    length = len(raw) // 4
                    cls = -(-length // shape.grid)
                    rows.append(
                        (doc_id, start, length, zlib.crc32(raw), len(ids), cls, task, int(seen[cls]), raw if with_ids else None)
                    )
                    seen[cls] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW
            ) if rows else pa.RecordBatch.from_pylist([], schema=_ARROW)

    return stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(thrifty(cut), _PIECE_SCHEMA), "pieces"
    )


_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    + [("cls", pa.int32()), ("task", pa.int32()), ("nth", pa.int64()), ("ids", pa.binary())]
)


# The plan: small dense arithmetic on the histogram, on the driver.


def _knapsack(sizes: np.ndarray, values: np.ndarray, units: int) -> np.ndarray:
    """How many of each size give the greatest value within ``units``; each may be used again."""
    best, choice = np.zeros(units + 1), np.full(units + 1, -1)
    for room in range(1, units + 1):
        fits = np.searchsorted(sizes, room, "right")
        best[room] = best[room - 1]
        if fits:
            gain = best[room - sizes[:fits]] + values[:fits]
            k = int(np.argmax(gain))
            if gain[k] > best[room] + 1e-12:
                best[room], choice[room] = gain[k], k
    counts, room = np.zeros(len(sizes)), units
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return counts


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By elimination, a row at a time: library routines with threads of their own can hang beside the JVM."""
    n = len(matrix)
    work = np.hstack([matrix, np.eye(n)])
    for i in range(n):
        pivot = i + int(np.argmax(np.abs(work[i:, i])))
        work[[i, pivot]] = work[[pivot, i]]
        work[i] /= work[i, i]
        factors = work[:, i].copy()
        factors[i] = 0.0
        work -= factors[:, None] * work[i]
    return work[:, n:]


def solve(sizes: np.ndarray, demand: np.ndarray, units: int, rounds: int = 3000) -> tuple[np.ndarray, np.ndarray]:
    """The linear program by column generation: patterns (a column each) and how often to use each.

    A revised simplex over as many rows as there are lengths, with the demand perturbed a little against
    cycling. Starts from patterns of one length. Ends when no pattern has a value above 1 at the duals, or when the plan
    is within half a sequence, or a part in 10,000, of a lower bound (the total length, or the duals scaled by the best
    value), or after ``rounds``; the plan is feasible in each case.
    """
    m = len(sizes)
    bound = sizes @ demand / units
    demand = demand + 1e-4 * np.arange(1, m + 1) / m
    patterns = np.diag((units // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(patterns))
    use = inverse @ demand
    for k in range(rounds):
        if k % 200 == 199:
            inverse = _inverse(patterns)
            use = np.maximum(inverse @ demand, 0.0)
        duals = inverse.sum(axis=0)
        column = _knapsack(sizes, duals, units)
        value = duals @ column
        bound = max(bound, duals @ demand / value)
        if value <= 1.0 + 1e-7 or use.sum() - bound <= max(0.5, 1e-4 * bound):
            break
        step = inverse @ column
        ratio = np.full(m, np.inf)
        np.divide(use, step, out=ratio, where=step > 1e-9)
        out = int(np.argmin(ratio))
        use = np.maximum(use - ratio[out] * step, 0.0)
        use[out] = ratio[out]
        patterns[:, out] = column
        inverse[out] /= step[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(step[others], inverse[out])
    return patterns, use


def plan(histogram: dict[int, int], units: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns with their counts that hold each piece exactly once: ``(count, {class: pieces})``."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram))
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    patterns, use = solve(sizes, demand.astype(float), units)
    left, out = demand.copy(), []
    for column, times in zip(patterns.T.astype(np.int64), np.floor(use + 1e-9).astype(np.int64)):
        held = column > 0
        times = min(int(times), int((left[held] // column[held]).min()) if held.any() else 0)
        if times > 0:
            out.append((times, {int(s): int(n) for s, n in zip(sizes[held], column[held])}))
            left -= times * column
    while left.any():  # fewer pieces than the patterns hold together
        room, column = units, np.zeros_like(left)
        for k in range(len(sizes) - 1, -1, -1):
            column[k] = min(left[k], room // sizes[k])
            room -= column[k] * sizes[k]
        held = column > 0
        times = int((left[held] // column[held]).min())
        out.append((times, {int(s): int(n) for s, n in zip(sizes[held], column[held])}))
        left -= times * column
    return out


def _places(patterns: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each class: from which rank on, from which sequence on, and how many per sequence."""
    table: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, held in patterns:
        for cls, n in held.items():
            table.setdefault(cls, []).append((ranks.get(cls, 0), sequence, n))
            ranks[cls] = ranks.get(cls, 0) + times * n
        sequence += times
    return {cls: tuple(np.array(c) for c in zip(*rows)) for cls, rows in table.items()}


def pack(
    docs: DataFrame, shape: Shape | None = None, tokenizer: str = bpe.TOKENIZER, with_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    A document is its ids and ``END_ID``; null text is empty and gives one piece of one id. The pieces of a
    document follow each other by ``start``; those of a sequence by ``offset``, without gaps. Rows that
    repeat are packed each; null ids pass through; an empty table gives no rows. Other columns are ignored.
    """
    shape = shape or Shape()
    cut = pieces(docs, shape, tokenizer, with_ids)
    counts = cut.groupBy("task", "cls").agg(F.count("*").alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.partitionBy("cls").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    counts = stored(counts.select("task", "cls", "n", before.alias("before")), "piece_ranks")
    histogram = {r["cls"]: r["n"] for r in counts.groupBy("cls").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan(histogram, shape.units))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("cls", "rank"))
            sequence, turn = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
            for c in np.unique(cls):
                mine = cls == c
                ranks, sequences, each = places[int(c)]
                at = np.searchsorted(ranks, rank[mine], "right") - 1
                inside = rank[mine] - ranks[at]
                sequence[mine] = sequences[at] + inside // each[at]
                turn[mine] = inside % each[at]
            yield batch.append_column("sequence_id", pa.array(sequence)).append_column("turn", pa.array(turn))

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    ranked = cut.join(counts.drop("n"), ["task", "cls"]).select(
        *columns, "cls", (F.col("before") + F.col("nth")).alias("rank")
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema)
    placed = ranked.mapInArrow(thrifty(place), f"{schema}, sequence_id long, turn long")
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("cls"), "turn").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        *columns[:5],
        "sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"),
        *columns[5:],
    )
