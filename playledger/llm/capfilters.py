"""Near-duplicates among vectors by spherical-cap filters.

A filter is a direction; a vector belongs to its cap if their cosine exceeds ``alpha``. The directions are those of a few random
product codes: after a random rotation, a direction is one code vector for the first half of the dimensions beside one for the second
half. All caps that hold a vector are found by list decoding: a code vector of the first half is followed only if the best one of the
second half could lift the sum over ``alpha``. Vectors of one label that share a cap are compared exactly, in double precision; a pair that shares
several caps counts in the first of them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import stored
from playledger.llm.components import components


@dataclass(frozen=True)
class Caps:
    """What counts as near, and the filters.

    ``filters``: caps that a vector is expected in. ``crowd``: unrelated vectors that a cap is expected to hold, which sets how many
    directions there are: caps get smaller, and more, as the most frequent label grows, up to ``most`` code vectors for each half.
    Beyond that caps hold more vectors; none is left out.
    """

    threshold: float = 0.93
    codes: int = 8
    filters: float = 64.0
    crowd: float = 0.25
    least: int = 64
    most: int = 4096
    seed: int = 11

    def size(self, rows: int) -> int:
        """Code vectors for each half, if the most frequent label has so many rows."""
        wanted = np.sqrt(self.filters * max(1, rows) / self.crowd / self.codes)
        return int(np.clip(np.ceil(wanted), self.least, self.most))


#: Vectors of a cap that one task compares with as many others.
BLOCK = 512
#: Shorter vectors are filled up with zeros, which changes no cosine.
_LEAST_DIM = 16


def _alpha(dim: int, share: float) -> float:
    """The cosine that a share of all directions exceeds."""
    t = np.linspace(-1.0, 1.0, 400_001)
    weight = np.clip(1.0 - t * t, 0.0, None) ** ((dim - 3) / 2)
    above = np.cumsum(weight[::-1])[::-1] / weight.sum()
    return float(t[np.searchsorted(-above, -share)])


@functools.lru_cache(maxsize=4)
def _codes(dim: int, size: int, caps: Caps) -> tuple[float, list[tuple[np.ndarray, np.ndarray]]]:
    """``alpha`` and, for each code, the matrices that give a vector's products with the code vectors of both halves."""
    rng = np.random.default_rng([caps.seed, dim, size])
    made = []
    for _ in range(caps.codes):
        turned = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        halves = []
        for part in np.array_split(turned, 2, axis=1):
            code = rng.standard_normal((part.shape[1], size))
            halves.append(part @ (code / np.linalg.norm(code, axis=0) / np.sqrt(2.0)))
        made.append((halves[0], halves[1]))
    return _alpha(dim, caps.filters / (caps.codes * size * size)), made


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, without overflow; rows of zeros stay."""
    x = vectors.astype(np.float64)
    x /= np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0.0), np.finfo(float).tiny)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), np.finfo(float).tiny)


def decode(vectors: np.ndarray, size: int, caps: Caps) -> list[np.ndarray]:
    """The caps that hold each of the vectors (rows of length one), ascending."""
    n, dim = vectors.shape
    if dim < _LEAST_DIM:
        vectors, dim = np.pad(vectors, ((0, 0), (0, _LEAST_DIM - dim))), _LEAST_DIM
    alpha, made = _codes(dim, size, caps)
    rows, found = [], []
    step = max(1, (1 << 21) // size)
    for number, (first, second) in enumerate(made):
        for start in range(0, n, step):
            block = vectors[start : start + step]
            left, right = block @ first, block @ second
            row, one = np.nonzero(left >= (alpha - right.max(axis=1))[:, None])
            for at in range(0, len(row), step):
                r, c = row[at : at + step], one[at : at + step]
                k, other = np.nonzero(right[r] >= (alpha - left[r, c])[:, None])
                rows.append(start + r[k])
                found.append((number * size + c[k]) * size + other)
    row, cap = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((cap, row))
    return np.split(cap[order].astype(np.int32), np.cumsum(np.bincount(row, minlength=n))[:-1])


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _usable() -> Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _caps_of(classes: DataFrame, size: int, caps: Caps) -> DataFrame:
    """``rep, caps``: the caps of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy()
            out: list = [None] * len(lengths)
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                for i, found in zip(at, decode(unit(_matrix(batch.column(1).take(pa.array(at)))), size, caps)):
                    out[i] = found
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["rep", "caps"])

    return classes.select("rep", "embedding").mapInArrow(run, "rep long, caps array<int>")


def _earlier(lists: list[np.ndarray], cap: int) -> np.ndarray:
    """Which pairs share a cap before ``cap``."""
    before = [x[: np.searchsorted(x, cap)] for x in lists]
    caps, where = np.unique(np.concatenate(before), return_inverse=True)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in before])
    often = np.bincount(where, minlength=len(caps)) > 1
    owner, where = owner[often[where]], (np.cumsum(often) - 1)[where[often[where]]]
    shared = np.zeros((len(lists), len(lists)), bool)
    for start in range(0, int(often.sum()), 4096):
        at = (where >= start) & (where < start + 4096)
        has = np.zeros((len(lists), min(4096, int(often.sum()) - start)), np.float32)
        has[owner[at], where[at] - start] = 1.0
        shared |= (has @ has.T) > 0.5
    return shared


def _compare(cap: int, split: bool, block: np.ndarray, vectors: np.ndarray, weight: np.ndarray, lists: list, threshold: float):
    """Links of each vector and the first vector that it reaches, within one cap."""
    near = vectors @ vectors.T >= threshold
    np.fill_diagonal(near, False)
    if split:
        near &= block[:, None] != block[None, :]
    if not near.any():
        return None
    some = np.flatnonzero(near.any(axis=1))
    near = near[np.ix_(some, some)] & ~_earlier([lists[i] for i in some], cap)
    if not near.any():
        return None
    first = np.arange(len(some))
    while True:
        low = np.minimum(first, np.where(near, first[None, :], len(some)).min(axis=1))
        low = low[low]
        if (low == first).all():
            break
        first = low
    return some, near @ weight[some], some[first]


def _links(rows: DataFrame, caps: Caps) -> DataFrame:
    """``rep, links, peer``: for each class and task, how many vectors it is linked with there, and one class that it reaches.

    The rows come sorted, so that a task holds two blocks of one cap at a time.
    """
    keys = ["group", "cap", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group = pa.Table.from_batches(parts).combine_chunks()
            if len(group) < 2:
                return
            lists = [x.values.to_numpy() for x in group.column("caps")]
            found = _compare(
                group.column("cap")[0].as_py(),
                group.column("lo")[0] != group.column("hi")[0],
                group.column("block").to_numpy(),
                unit(_matrix(group.column("embedding").combine_chunks())),
                group.column("weight").to_numpy(),
                lists,
                caps.threshold,
            )
            if found:
                rep = group.column("rep").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[found[0]]), pa.array(found[1]), pa.array(rep[found[2]])], names=["rep", "links", "peer"]
                )

        parts: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            columns = [batch.column(name).to_numpy() for name in keys]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for start, end in zip([0, *change], [*change, len(batch)]):
                now = tuple(c[start] for c in columns)
                if parts and now != key:
                    yield from compared(parts)
                    parts = []
                key = now
                parts.append(batch.slice(start, end - start))
        if parts:
            yield from compared(parts)

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "rep long, links long, peer long")


def near_vectors(vectors: DataFrame, caps: Caps | None = None) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    ``vectors``: ``vec_id, embedding, label``; other columns are ignored. Two vectors of equal label and length are linked if their cosine
    is at least the threshold. Without a label, and where the vector is null, zero, or holds null or non-finite components, a row is linked with nothing.
    Each row counts, also one that repeats an id or a vector. A row without an id takes part; it gives no ``component_id``, and has null there if it
    reaches no id. Texts play no part; long vectors cost in proportion to the square of their length (the rotation). An empty table gives no rows.

    Equal vectors are one class from the start: a vector that a third of all rows repeat is one row per task before it is shuffled.
    Classes that no other one meets in a cap are dropped before vectors move. The vectors of a cap are compared by blocks, so that no task holds
    more than two, and only counts and one path to each linked vector come out, not the pairs. In a group of different vectors that are all near each other, all pairs are
    still compared, as each has to be counted.
    """
    caps = caps or Caps()
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    # Length and label are part of the key; two hashes, so that different vectors do not meet at any size.
    parts = [F.size("embedding"), F.col("label"), F.col("embedding")]
    keyed = ids.select(
        "vec_id", "label", "embedding", _usable().alias("usable"),
        F.xxhash64(F.lit(1), *parts).alias("h1"), F.xxhash64(F.lit(2), *parts).alias("h2"),
    )
    classes = stored(
        keyed.where("usable")
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first(F.struct("label", "embedding")).alias("v"))
        .select(
            F.monotonically_increasing_id().alias("rep"), "h1", "h2", "least", "weight", "v.embedding",
            F.xxhash64(F.size("v.embedding"), "v.label").alias("group"),
        ),
        "vector_classes",
    )
    most = classes.groupBy("group").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    size = caps.size(most)
    entries = stored(_caps_of(classes, size, caps).join(classes.select("rep", "group"), "rep"), "vector_caps")
    single = entries.select("rep", "group", F.explode("caps").alias("cap"))
    shared = single.groupBy("group", "cap").agg(F.count("*").alias("n")).where("n > 1")
    met = single.join(shared, ["group", "cap"]).groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("cap", "n"))).alias("met"))
    bodies = classes.join(met, "rep").select("rep", "group", "weight", "embedding", F.col("met.cap").alias("caps"), F.explode("met").alias("m"))
    blocks = F.ceil(F.col("m.n") / BLOCK).cast("int")
    dealt = bodies.select(
        "rep", "group", "weight", "embedding", "caps", F.col("m.cap").alias("cap"), blocks.alias("blocks"),
        F.pmod(F.xxhash64("rep", F.lit(7)), blocks).cast("int").alias("block"),
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = dealt.select(
        "group", "cap", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "rep", "weight", "embedding", "caps", "block",
    )
    links = stored(_links(rows, caps), "vector_links")
    found = components(links.select(F.col("rep").alias("a"), F.col("peer").alias("b"))).toDF("rep", "component")
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    named = stored(
        classes.select("rep", "h1", "h2", "least", "weight")
        .join(counted, "rep", "left")
        .join(found, "rep", "left")
        .select("h1", "h2", "least", F.coalesce("component", "rep").alias("component"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links")),
        "vector_named",
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    verdict = named.join(least, "component").select("h1", "h2", "links", "component_id", F.lit(True).alias("usable"))
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return (
        keyed.select("vec_id", "usable", "h1", "h2")
        .join(verdict, ["h1", "h2", "usable"], "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
