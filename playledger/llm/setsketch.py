"""Near-duplicates by SetSketch registers.

A document is a set of word shingles. Each register of its sketch holds the least of an exponential hash over the set, on
an exponential scale cut at both ends: ``K = floor(1 - log_b(min))``. Registers of a union are the greater
of the registers, so sketches of parts of a text can be merged. Registers of two sets are equal with a probability close to
their Jaccard similarity, so runs of registers ("bands") serve as bucket keys. For a pair that shares a bucket, the numbers of
greater, equal and smaller registers have a likelihood that depends on the two sizes, which are known, and on the similarity; its maximum is the
joint estimate. Pairs that are not far below the threshold by it are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import is_taken, process_cache, slot, stored, taken_slots, thrifty
from playledger.llm.components import components


@dataclass(frozen=True)
class Near:
    """What counts as near, and the sketch.

    A pair at the threshold shares no bucket with probability ``(1 - j ** rows) ** bands``: 1e-9 for 0.85 by default.
    """

    #: Least similarity, as a fraction ``num / den``.
    num: int = 85
    den: int = 100
    shingle: int = 3
    bands: int = 28
    rows: int = 4
    #: Base of the registers' scale, and the largest register less one.
    base: float = 1.001
    limit: int = 65_534

    @property
    def registers(self) -> int:
        return self.bands * self.rows


#: Fixed odd multipliers of the shingle hash.
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA5A3564E27F88865], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[1]
    x = (x ^ (x >> np.uint64(29))) * _MIX[2]
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text. A-Z count as a-z.

    A text of fewer words than ``size`` has its whole sequence of words as one; one without words has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(size, len(words))
    count = len(words) - span + 1
    mixed = np.full(count, np.uint64(span))
    for k in range(span):
        mixed = _mixed(mixed * _MIX[0] + ids[k : k + count])
    return np.unique(mixed)


def _multipliers(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * _MIX[3]) | np.uint64(1)


def registers(hashes: np.ndarray, near: Near) -> np.ndarray:
    """The sketch of a set of hashes; of an empty set, zeros.

    The least of the uniform hashes gives the least of the exponential ones, so one logarithm per register suffices.
    """
    if not len(hashes):
        return np.zeros(near.registers, np.uint16)
    factors = _multipliers(near.registers)[:, None]
    least = np.full(near.registers, np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[None, i : i + 1024] * factors).min(axis=1), out=least)
    # u in (0, 1): minus its logarithm's complement is the least of as many Exp(1) values.
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
    # Scaled so that the registers of one element lie near zero and of 2**64 elements below the limit.
    scaled = np.floor(1.0 - np.log(smallest / 20.0) / np.log(near.base))
    return np.clip(scaled, 0, near.limit + 1).astype(np.uint16)


def estimate(greater: np.ndarray, smaller: np.ndarray, n: np.ndarray, m: np.ndarray, near: Near) -> np.ndarray:
    """Similarity of greatest likelihood, given sizes ``n`` and ``m`` and how many registers of the first are greater and smaller.

    For sets with a share ``u`` of the union only in the first and ``v`` only in the second, a register is greater with
    probability ``p(u)`` and smaller with ``p(v)``, where ``p(x) = -log_b(1 - x (b - 1) / b)``. The likelihood is taken on a grid.
    """
    b, k = near.base, near.registers
    j = np.linspace(0.0, 1.0, 201)[None, :]
    n, m = n[:, None].astype(float), m[:, None].astype(float)
    union = (n + m) / (1.0 + j)
    u, v = np.clip((union - m) / union, 0.0, 1.0), np.clip((union - n) / union, 0.0, 1.0)
    possible = j <= np.minimum(n, m) / np.maximum(n, m) + 1e-9
    up, down = (np.clip(-np.log1p(-x * (b - 1.0) / b) / np.log(b), 1e-9, 1.0) for x in (u, v))
    same = np.clip(1.0 - up - down, 1e-9, 1.0)
    g, s = greater[:, None], smaller[:, None]
    score = g * np.log(up) + s * np.log(down) + (k - g - s) * np.log(same)
    return j[0][np.argmax(np.where(possible, score, -np.inf), axis=1)]


_SKETCH = "doc_id long, n_shingles long, digest binary, sketch binary"


def sketches(docs: DataFrame, near: Near) -> DataFrame:
    """``doc_id``, size of the set, digest of the set (equal sets, equal digests) and registers, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_cache("sketches", dict)
        for batch in batches:
            sizes, digests, regs = [], [], []
            for text in batch.column(1):
                hashes = shingles(text.as_py(), near.shingle)
                sizes.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                regs.append(registers(hashes, near).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(regs, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(thrifty(run), _SKETCH)


#: Documents of a bucket that one task compares with as many others, and pairs that it looks at at once.
BLOCK, PAIRS = 1024, 16_384


def _deviations_below(near: Near) -> float:
    """An estimate lower than this belongs to a pair at the threshold with a probability of about 1e-9."""
    j = near.num / near.den
    return j - 6.0 * float(np.sqrt(j * (1.0 - j) / near.registers))


def _confirmed(x: np.ndarray, y: np.ndarray, near: Near) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return near.den * both >= near.num * (len(x) + len(y) - both)


def _arrays(column, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column]


def _far(greater: np.ndarray, smaller: np.ndarray, n: np.ndarray, m: np.ndarray, near: Near) -> np.ndarray:
    """Which pairs have an ``estimate`` that is clearly too low, without its grid.

    As the base is close to one, a register is greater with probability ``u``, smaller with ``v`` and equal with ``j``, all linear in ``j``. The
    likelihood is then concave: where it falls at a similarity, its maximum lies below. It is looked at 0.02 below the cut, so near cuts are left to the grid.
    """
    j = _deviations_below(near) - 0.02
    if j <= 0:
        return np.zeros(len(n), bool)
    x, y = m / (n + m), n / (n + m)
    equal = near.registers - greater - smaller
    u, v = (np.maximum(1.0 - z * (1.0 + j), 1e-9) for z in (x, y))
    return equal / j < greater * x / u + smaller * y / v


def _likely(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, near: Near) -> np.ndarray:
    """Which pairs of rows of ``x`` and ``y`` may be near, by size and by the joint estimate."""
    fits = _sizes_fit(n, m, near)
    at = np.flatnonzero(fits)
    greater, smaller = (x[at] > y[at]).sum(1), (x[at] < y[at]).sum(1)
    far = _far(greater, smaller, n[at], m[at], near)
    fits[at[far]] = False
    at, greater, smaller = at[~far], greater[~far], smaller[~far]
    if len(at):
        fits[at] = estimate(greater, smaller, n[at], m[at], near) >= _deviations_below(near)
    return fits


def _sizes_fit(n: np.ndarray, m: np.ndarray, near: Near) -> np.ndarray:
    return near.den * np.minimum(n, m) >= near.num * np.maximum(n, m)


def _bands(classes: DataFrame, near: Near) -> DataFrame:
    """``key, band, rep``: a row for each band of each sketch."""
    width = 2 * near.rows
    parts = [
        F.struct(F.lit(i).alias("band"), F.xxhash64(F.lit(i), F.substring("sketch", i * width + 1, width)).alias("key"))
        for i in range(near.bands)
    ]
    return classes.select("rep", F.explode(F.array(*parts)).alias("x")).select("x.key", "x.band", "rep")


def _sets(docs: DataFrame, reps: DataFrame, near: Near) -> DataFrame:
    """``rep, hashes``: full sets of the documents ``reps``.

    A table of bits of a fixed size, one for each slot that an id of ``reps`` falls into, rules out most others where they stand, so that
    their texts need not move. The join then decides.
    """
    shared = docs.sparkSession.sparkContext.broadcast(taken_slots(reps.select(slot("rep").alias("slot"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(is_taken(shared.value, batch.column(2).to_numpy()), pa.bool_()))
            found = [shingles(t.as_py(), near.shingle).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["rep", "hashes"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").where("rep IS NOT NULL")
    return texts.withColumn("slot", slot("rep")).mapInArrow(thrifty(run), "rep long, hashes binary").join(reps, "rep", "left_semi")


def _likely_pairs(pairs: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """``a, b`` of the pairs that are likely by their sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.array(_arrays((v.as_py() for v in batch.column(i)), "<u2")).reshape(-1, near.registers) for i in (2, 4))
            n, m = (batch.column(i).to_numpy() for i in (3, 5))
            yield batch.select([0, 1]).filter(pa.array(_likely(x, y, n, m, near), pa.bool_()))

    one, other = (classes.select("rep", "sketch", "size").toDF(k, f"s{k}", f"n{k}") for k in "ab")
    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "sa", "na", "sb", "nb")
    return joined.mapInArrow(thrifty(run), "a long, b long").distinct()


def _star_links(pairs: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """``a, b`` of the pairs that are near, by their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for ha, hb in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(h.as_py(), np.uint64) for h in (ha, hb))
                keep.append(_confirmed(p, q, near))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.toDF("a", "ha"), "a").join(sets.toDF("b", "hb"), "b")
    return joined.select("a", "b", "ha", "hb").mapInArrow(thrifty(run), "a long, b long")


def _sketch_rows(column: pa.ChunkedArray, near: Near) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, near.registers)


def _open_pairs(rows: pa.Table, first: np.ndarray, near: Near) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of rows that are in two blocks of a bucket, likely near, in different components, and share no band before this one.

    ``first``: where the groups of rows begin. Pairs of all groups are made together, some at a time, in the order of their first rows.
    """
    total = rows.num_rows
    sketch = _sketch_rows(rows.column("sketch"), near)
    size, block, band, component, lo, hi = (rows.column(c).to_numpy() for c in ("size", "block", "band", "component", "lo", "hi"))
    lengths = np.diff(np.append(first, total))
    later = np.repeat(first + lengths, lengths) - np.arange(total) - 1
    until = np.cumsum(later)
    start = 0
    while start < total:
        end = max(start + 1, int(np.searchsorted(until, until[start] - later[start] + PAIRS, "right")))
        i = np.repeat(np.arange(start, end), later[start:end])
        j = i + 1 + np.arange(len(i)) - np.repeat(until[start:end] - later[start:end] - until[start] + later[start], later[start:end])
        start = end
        may = (component[i] != component[j]) & ((lo[i] == hi[i]) | (block[i] != block[j])) & _sizes_fit(size[i], size[j], near)
        i, j = i[may], j[may]
        same = (sketch[i] == sketch[j]).reshape(len(i), near.bands, near.rows).all(2)
        may = same.argmax(1) == band[i]
        i, j = i[may], j[may]
        may = _likely(sketch[i], sketch[j], size[i], size[j], near)
        if may.any():
            yield i[may], j[may]


def _of_blocks(rows: DataFrame, run: Callable[[pa.Table, np.ndarray], pa.RecordBatch | pa.Table], schema: str) -> DataFrame:
    """``run`` over whole groups of equal ``key, lo, hi``, many at a time as most are small, and where each begins."""
    keys = ["key", "lo", "hi"]

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*waiting, batch])
            first = _first_rows(table)
            # The last group may go on in the next batch.
            if first[-1]:
                yield from run(table.slice(0, first[-1]), first[:-1]).to_batches()
            waiting = table.slice(first[-1]).to_batches()
        if waiting:
            table = pa.Table.from_batches(waiting)
            yield from run(table, _first_rows(table)).to_batches()

    def _first_rows(table: pa.Table) -> np.ndarray:
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([(c := table.column(k).to_numpy())[1:] != c[:-1] for k in keys], axis=0)
        return np.flatnonzero(new)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(thrifty(of_task), schema)


_BLOCK_ROW = "key long, band int, lo int, hi int, rep long, component long, block int, sketch binary, size long"


def _in_doubt(buckets: DataFrame, found: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """Rows of the blocks of buckets that have a likely partner in another component, by sketches alone.

    Buckets whose documents are in one component are done. Of the others, each pair of two components is tried, in the
    first band that it shares, by blocks of documents, so that no task holds a whole large bucket; at most the rows of a block come out.
    """
    labelled = buckets.join(found.toDF("rep", "component"), "rep", "left").select(
        "key", "band", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = (
        labelled.groupBy("key")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("members"))
        .where("least < most")
        .select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    rows = labelled.join(mixed, "key").select(
        "*", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int").alias("block")
    )
    tasks = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "rep", "component", "block"
    )

    def run(table: pa.Table, first: np.ndarray) -> pa.Table:
        doubt = np.zeros(table.num_rows, bool)
        for i, j in _open_pairs(table, first, near):
            doubt[i] = doubt[j] = True
        return table.filter(pa.array(doubt))

    names = [n.split()[0] for n in _BLOCK_ROW.split(", ")]
    joined = tasks.join(classes.select("rep", "sketch", "size"), "rep").select(names)
    return _of_blocks(joined, run, _BLOCK_ROW)


def _rest_links(doubtful: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """``a, b``: links between the doubtful rows of each pair of blocks, confirmed on their sets; those that join nothing new are left out."""

    def run(table: pa.Table, first: np.ndarray) -> pa.Table:
        sets, rep = _arrays((h.as_py() for h in table.column("hashes")), "<u8"), table.column("rep").to_numpy()
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, table.num_rows)))
        component = table.column("component").to_numpy().copy()
        a, b = [], []
        for rows, others in _open_pairs(table, first, near):
            for i, k in zip(rows.tolist(), others.tolist()):
                if component[k] != component[i] and _confirmed(sets[i], sets[k], near):
                    a.append(rep[i])
                    b.append(rep[k])
                    own = component[first[group[i]] : (first[group[i] + 1] if group[i] + 1 < len(first) else None)]
                    own[own == component[k]] = component[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return _of_blocks(doubtful.join(sets, "rep"), run, "a long, b long")


def near_duplicates(docs: DataFrame, near: Near | None = None, named: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the least id that can be reached by links; ``kept``: it is the document's own.
    Documents without words are linked with nothing. Null ids take part in nothing but equal sets: beside documents with
    an id they go, else they stay. Rows that repeat an id count as one document. Other columns are ignored.
    ``named``: a condition on ``doc_id``; the ids for which it does not hold count as null, and their ``component_id`` is null if they stay.

    Equal sets are one class, whose least id stands for it. The classes of a bucket are compared with the one of
    them that shares most buckets with others ("star"), which finds nearly all links at a cost in proportion to the rows.
    Pairs that share a bucket but are in different components after that are then tried too, so that no candidate is left out.
    """
    near = near or Near()
    sketched = stored(sketches(docs, near), "sketches")
    own_id = F.min(F.when(named, F.col("doc_id")) if named is not None else "doc_id")
    of_set = sketched.where("n_shingles > 0").groupBy("digest", "sketch")
    classes = stored(of_set.agg(own_id.alias("rep"), F.min("n_shingles").alias("size")).where("rep IS NOT NULL"), "classes")
    bands = _bands(classes, near)
    shared = bands.groupBy("key").agg((F.count("*") - 1).alias("others")).where("others > 0")
    buckets = stored(bands.join(shared, "key"), "buckets")
    score = buckets.groupBy("rep").agg(F.sum("others").alias("score"))
    scored = buckets.join(score, "rep")
    centre = scored.groupBy("key").agg(F.max(F.struct("score", F.expr("-rep").alias("id"))).alias("c")).select(
        "key", F.expr("-c.id").alias("centre")
    )
    pairs = buckets.join(centre, "key").where("rep <> centre").select(
        F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")
    )
    likely = stored(_likely_pairs(pairs.distinct(), classes, near), "likely")
    ends = likely.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    links = stored(_star_links(likely, stored(_sets(docs, ends, near), "sets"), near), "star_links")
    found = components(links)
    doubtful = stored(_in_doubt(buckets, found, classes, near), "in_doubt")
    sets = stored(_sets(docs, stored(doubtful.select("rep").distinct(), "doubtful"), near), "rest_sets")
    rest = stored(_rest_links(doubtful, sets, near), "rest_links")
    joined = components(links.union(rest)) if rest.take(1) else found
    known = classes.join(joined.toDF("rep", "component"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    named = stored(known, "classes_named")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (
        sketched.join(named, "digest", "left")
        .withColumn("component_id", component)
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
