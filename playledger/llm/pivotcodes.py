"""Compression of vectors to short codes: one codebook for each part of a vector, entries chosen with pivots (LAESA).

Vectors become integers, and all distances are exact. A few fixed points of each part, the pivots, are measured against every part once. By
the triangle inequality the distance between a part and an entry is at least the difference of their distances to a pivot. Each round thus measures
only the entries against the pivots; a part then tries the entries in the order of these bounds and stops where a bound exceeds the best
distance found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import stored

PARTS, ENTRIES, ROUNDS, PIVOTS = 8, 16, 6, 4
SCALE = 4096
#: Integers of greater magnitude count as this, so that squared distances fit in 64 bits.
LARGEST = 2**27
#: Bounds come from square roots in double precision; an entry is skipped only if they exceed the best distance by more than their error.
_SLACK = 1.0 - 1e-9


def whole(vectors: list[np.ndarray], dim: int) -> np.ndarray:
    """``floor(4096 x)`` of each component; short vectors are filled up with zeros."""
    out = np.zeros((len(vectors), dim), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = np.clip(np.floor(v.astype(np.float64) * SCALE), -LARGEST, LARGEST)
    return out


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances between rows, exact."""
    d = x[:, None, :] - y[None, :, :]
    return (d * d).sum(axis=2)


def pick_pivots(codebook: np.ndarray) -> np.ndarray:
    """Entries far from each other: the first, then each time the one whose nearest pivot is farthest."""
    chosen = [0]
    while len(chosen) < min(PIVOTS, len(codebook)):
        least = _squares(codebook, codebook[chosen]).min(axis=1)
        chosen.append(int(least.argmax()))
    return codebook[chosen]


def nearest(parts: np.ndarray, to_pivots: np.ndarray, codebook: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry (of equally near ones the lowest), its squared distance, and how many distances were evaluated."""
    entry_to_pivots = np.sqrt(_squares(codebook, pivots).astype(np.float64))
    bounds = np.abs(to_pivots[:, None, :] - entry_to_pivots[None, :, :]).max(axis=2)
    order = np.argsort(bounds, axis=1, kind="stable")
    least = np.take_along_axis(bounds, order, axis=1) ** 2 * _SLACK - 1e-3
    best = np.full(len(parts), np.iinfo(np.int64).max)
    index = np.zeros(len(parts), np.int64)
    active = np.arange(len(parts))
    evaluated = 0
    for rank in range(len(codebook)):
        active = active[least[active, rank] <= best[active]]
        if not len(active):
            break
        entry = order[active, rank]
        d = parts[active] - codebook[entry]
        squares = (d * d).sum(axis=1)
        evaluated += len(active)
        better = (squares < best[active]) | ((squares == best[active]) & (entry < index[active]))
        best[active[better]], index[active[better]] = squares[better], entry[better]
    return index, best, evaluated


def _lists(column: pa.Array) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False) for x in column]


def _prepared(vectors: DataFrame, dim: int, pivots: np.ndarray) -> DataFrame:
    """``vec_id, label``, the integers, and the distances of each part to the pivots, measured here only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(_lists(batch.column(2)), dim)
            far = np.stack([np.sqrt(_squares(x[:, part], p).astype(np.float64)) for part, p in zip(_slices(dim), pivots)], axis=1)
            columns = [pa.array([row.tobytes() for row in array], pa.binary()) for array in (x, far)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["vec_id", "label", "ints", "far"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id long, label {kind}, ints binary, far binary")


def _slices(dim: int) -> list[slice]:
    step = dim // PARTS
    return [slice(i * step, (i + 1) * step) for i in range(PARTS)]


def _read(batch: pa.RecordBatch, dim: int, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column("ints").to_pylist()), np.int64).reshape(-1, dim)
    far = np.frombuffer(b"".join(batch.column("far").to_pylist()), np.float64).reshape(-1, PARTS, pivots)
    return x, far


def _sums(prepared: DataFrame, dim: int, codebooks: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``part, entry, n, evaluated`` and the componentwise sums, added up in each task first."""
    step = dim // PARTS
    names = ["part", "entry", "n", "evaluated", *[f"s{i}" for i in range(step)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, codebooks.shape[1], step), np.int64)
        counts = np.zeros((2, PARTS, codebooks.shape[1]), np.int64)
        for batch in batches:
            x, far = _read(batch, dim, pivots.shape[1])
            for part, at in enumerate(_slices(dim)):
                index, _, evaluated = nearest(x[:, at], far[:, part], codebooks[part], pivots[part])
                np.add.at(sums[part], index, x[:, at])
                counts[0, part] += np.bincount(index, minlength=codebooks.shape[1])
                counts[1, part, 0] += evaluated
        part, entry = np.indices(counts.shape[1:])
        columns = [part.ravel(), entry.ravel(), counts[0].ravel(), counts[1].ravel(), *sums.reshape(-1, step).T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    # Sums of sums may leave 64 bits at very many rows.
    total = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names[2:]]
    rows = prepared.select("ints", "far").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    return rows.groupBy("part", "entry").agg(*total)


def train(prepared: DataFrame, dim: int, codebooks: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The codebooks after all rounds, and the number of distances evaluated in each. A round gives at most 128 rows to the driver."""
    evaluated = []
    for _ in range(ROUNDS):
        codebooks, rows = codebooks.copy(), _sums(prepared, dim, codebooks, pivots).collect()
        evaluated.append(int(sum(r["evaluated"] for r in rows)))
        for r in rows:
            if r["n"]:
                codebooks[r["part"], r["entry"]] = [int(r[f"s{i}"]) // int(r["n"]) for i in range(dim // PARTS)]
    return codebooks, evaluated


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def _codes(prepared: DataFrame, dim: int, codebooks: np.ndarray, pivots: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, far = _read(batch, dim, pivots.shape[1])
            index = np.zeros((len(x), PARTS), np.uint8)
            error = np.zeros(len(x), np.int64)
            for part, at in enumerate(_slices(dim)):
                index[:, part], best, _ = nearest(x[:, at], far[:, part], codebooks[part], pivots[part])
                error += best
            columns = [pa.array([row.tobytes().hex() for row in index], pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *columns], names=["vec_id", "label", "code", "error"])

    kind = prepared.schema["label"].dataType.simpleString()
    return prepared.mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


_RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def compress(vectors: DataFrame) -> DataFrame:
    """One row per vector: ``vec_id, code, error, label_error, codebooks_sha256``.

    ``vectors``: ``vec_id, embedding, label``; other columns are ignored. Rows whose vector is null or holds null or non-finite components are dropped.
    All rows count, also those that repeat an id; the first entries are the 16 smallest ids (null last; of one id, the smaller vector first), or all
    of them if there are fewer. Vectors of different lengths are filled up with zeros to the greatest length, and that to a multiple of 8; empty
    vectors are zeros. Components of 2**15 and more count as 2**15. An empty table gives no rows. Texts play no part.

    Every round reads the written integers and pivot distances once and shuffles 128 sums per task; codebooks (128 entries) are all
    that the driver holds. A label with a third of all rows is one row per task when errors are added up.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")).where(finite)
    smallest = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(ENTRIES).collect()
    if not smallest:
        return spark.createDataFrame([], _RESULT)
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    dim = max(PARTS, -(-longest // PARTS) * PARTS)
    start = whole([np.array(r["embedding"], np.float64) for r in smallest], dim)
    codebooks = np.stack([start[:, at] for at in _slices(dim)])
    pivots = np.stack([pick_pivots(c) for c in codebooks])
    prepared = stored(_prepared(rows, dim, pivots), "pivot_distances")
    codebooks, _ = train(prepared, dim, codebooks, pivots)
    coded = stored(_codes(prepared, dim, codebooks, pivots), "vector_codes")
    # A null label joins as a label of its own.
    key = [F.col("label").isNull().alias("no_label"), F.coalesce("label", F.lit(0).cast(coded.schema["label"].dataType)).alias("label")]
    keyed = coded.select("vec_id", "code", "error", *key)
    totals = keyed.groupBy("no_label", "label").agg(F.sum("error").alias("label_error"))
    return keyed.join(totals, ["no_label", "label"]).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
