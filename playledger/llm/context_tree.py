"""Language-model scores by context-tree weighting.

A text is its words in lower case (A-Z), each closed by a space, and one end. Each byte is eight binary decisions.
A decision is predicted in the contexts of 0 to ``DEPTH`` earlier bytes of the text by Krichevsky-Trofimov
estimates, and the depths are mixed by the weights of context-tree weighting, which follow from the counts:
``P_w = (P_kt + product of the children's P_w) / 2``. Contexts reach over the words before. The model is made of the
table of distinct grams (a byte and its longest context) and used by it: no part of it has to fit into one process.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import stored, thrifty

#: Bytes of the longest context. With the byte that it predicts they form a "gram", a 64-bit number.
DEPTH = 7
#: Bytes of the context by which the tree is dealt out to tasks; the tree above has a bounded size.
TOP = 2
CLOSE, END = b" ", b"\n"
LN2 = math.log(2.0)
#: Least probability of a bit.
LEAST = 1e-7
#: Words that are held in each process for scoring: those of at most so many bytes that make up this share of all training words
#: or more, of which there are at most 1 / share. All others are joined.
FREQUENT_SHARE, FREQUENT_BYTES = 1 / 2_000_000, 32
#: Grams that are held in each process for scoring, the most frequent ones, at most so many. All others are joined.
FREQUENT_GRAMS = 2_000_000
#: Bytes of text that are handled at once, and distinct grams that a task counts before it hands them on.
BLOCK, FLUSH = 2_000_000, 4_000_000
#: Bytes of text whose grams a task holds while it scores. Each hands on a run for each part, so much smaller ones would cost space.
CHUNK = 4_000_000
#: Grams are dealt out in so many parts at least, and one for so many bytes of all texts.
PARTS, PART_BYTES = 64, 16_000_000
#: Grams from which on a row of the table of counts is full.
ROW = 250_000

_SMALL = 4096
_LG_HALF = np.array([math.lgamma(i + 0.5) for i in range(_SMALL)])
_LG_ONE = np.array([math.lgamma(i + 1.0) for i in range(_SMALL)])


def _lgamma(n: np.ndarray, add: float, table: np.ndarray) -> np.ndarray:
    """``lgamma(n + add)`` for whole ``n``: a table, and Stirling's series above it."""
    out = table[np.minimum(n, _SMALL - 1).astype(np.int64)]
    large = np.flatnonzero(n >= _SMALL)
    if len(large):
        x = n.flat[large] + add
        out.flat[large] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1.0 / (12.0 * x)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of a sequence of so many zeros and ones by the Krichevsky-Trofimov estimator."""
    return (
        _lgamma(zeros, 0.5, _LG_HALF) + _lgamma(ones, 0.5, _LG_HALF) - 2 * _LG_HALF[0] - _lgamma(zeros + ones, 1.0, _LG_ONE)
    )


def closed(words: list[bytes]) -> list[bytes]:
    """Words as units of their own."""
    return [w + CLOSE if w else END for w in words]


def grams(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of byte strings (whole texts, or words), and to which of them each belongs. Contexts before a string are zero bytes."""
    keys, owner = _flipped_grams(units)
    return keys.byteswap(), owner


def _flipped_grams(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same with the last byte of each gram in the first place."""
    pad = bytes(DEPTH)
    lengths = np.array([len(u) for u in units])
    data = np.frombuffer(b"".join([x for u in units for x in (pad, u)]), np.uint8)
    # A window of eight bytes at every byte, but for those that end in the padding.
    windows = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (len(data) - DEPTH,), (1,))
    owner = np.repeat(np.arange(len(units)), lengths)
    return windows[np.arange(len(owner)) + DEPTH * owner], owner


def subtree(keys: np.ndarray, n: np.ndarray, top: int, mix: bool = True) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The tree over distinct grams, from the longest contexts up to those of ``top`` bytes.

    Gives for each gram and bit the mixed probability of a one (none without ``mix``), or NaN if not even the node at ``top`` was seen, and the nodes at ``top``: ``node, bit, zeros, ones, log_pw``.
    A context that was never seen predicts as the longest one that was.

    With the last byte first and the nearest bytes of the context next, the grams of a node are neighbours at every depth once they are sorted.
    """
    mixed = np.empty((len(keys) if mix else 0, 8))
    roots: dict[str, list[np.ndarray]] = {c: [] for c in ("node", "bit", "zeros", "ones", "log_pw")}
    flipped = keys.byteswap()
    for bit in range(8):
        ones = ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        cleared = flipped & ~np.uint64(((1 << (8 - bit)) - 1) << 56)
        order = np.argsort(cleared)
        nodes, up, first = _grouped(cleared[order])
        zero = np.add.reduceat(np.where(ones, 0.0, n)[order], first)
        one = np.add.reduceat(np.where(ones, n, 0.0)[order], first)
        log_pw = log_kt(zero, one)
        levels = []  # from deep to shallow: how to get from the node below, its estimate, its weight, and whether the one below was seen
        estimate, seen = (one + 0.5) / (zero + one + 1.0), zero + one > 0
        deepest, to_node = estimate, up
        for depth in range(DEPTH - 1, top - 1, -1):
            nodes, up, first = _grouped(nodes & ~np.uint64((1 << (8 * (DEPTH - depth))) - 1))
            zero, one, below = (np.add.reduceat(v, first) for v in (zero, one, log_pw))
            own = log_kt(zero, one)
            log_pw = np.logaddexp(own, below) - LN2
            levels.append((up, (one + 0.5) / (zero + one + 1.0), np.exp(own - LN2 - log_pw), seen))
            seen = zero + one > 0
        if mix:
            at, p = to_node, deepest[to_node]
            for up, estimate, weight, was_seen in levels:
                known = was_seen[at]
                at = up[at]
                w = np.where(known, weight[at], 1.0)
                p = w * estimate[at] + (1.0 - w) * p
            mixed[order, bit] = np.where(seen[at], p, np.nan)
        for c, v in zip(roots, (nodes.byteswap(), np.full(len(nodes), bit), zero, one, log_pw)):
            roots[c].append(v)
    return mixed, {c: np.concatenate(v) for c, v in roots.items()}


def _grouped(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers of a sorted array, which of them each one is, and where they begin."""
    first = _starts(ordered)
    which = np.zeros(len(ordered), np.int64)
    which[first[1:]] = 1
    return ordered[first], np.cumsum(which), first


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct number begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


class Root:
    """The tree above ``TOP``: contexts of one byte and of none, from the sums of the nodes below. At most 2 ** 16 numbers of a kind."""

    def __init__(self, context: np.ndarray, bit: np.ndarray, zeros: np.ndarray, ones: np.ndarray, log_pw: np.ndarray) -> None:
        """One row per ``context`` (a context byte above a byte of which only the first ``bit`` bits are set) and ``bit``."""
        place = (context >> 8, self.inner(context & 0xFF, bit))
        zero, one, below = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
        for table, values in ((zero, zeros), (one, ones), (below, log_pw)):
            np.add.at(table, place, values)
        own = log_kt(zero, one)
        log_one = np.logaddexp(own, below) - LN2
        self.seen = zero + one > 0
        self.estimate, self.weight = (one + 0.5) / (zero + one + 1.0), np.exp(own - LN2 - log_one)
        zero, one = zero.sum(axis=0), one.sum(axis=0)
        own = log_kt(zero, one)
        self.base_estimate = (one + 0.5) / (zero + one + 1.0)
        self.base_weight = np.exp(own - LN2 - (np.logaddexp(own, log_one.sum(axis=0)) - LN2))

    @staticmethod
    def inner(byte: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """The number of a node within a byte: a one, and the bits before."""
        return (1 << bit) | (byte >> (8 - bit))

    def log10(self, keys: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """Log probability of the last byte of each gram, from its mixed probabilities at ``TOP``."""
        out = np.zeros(len(keys))
        byte, context = (keys & np.uint64(0xFF)).astype(np.int64), ((keys >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
        for bit in range(8):
            node = self.inner(byte, np.full_like(byte, bit))
            p = mixed[:, bit]
            w = np.where(np.isnan(p), 1.0, self.weight[context, node])
            p = w * self.estimate[context, node] + (1.0 - w) * np.nan_to_num(p)
            w = np.where(self.seen[context, node], self.base_weight[node], 1.0)
            p = np.clip(w * self.base_estimate[node] + (1.0 - w) * p, LEAST, 1.0 - LEAST)
            out += np.log10(np.where((byte >> (7 - bit)) & 1, p, 1.0 - p))
        return out


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _stream(tokens: list[bytes]) -> bytes:
    """The bytes of a whole text: its words, each closed, and the end."""
    return CLOSE.join([*tokens, END])


def _blocks(streams: list[bytes]) -> Iterator[tuple[int, int]]:
    """First and last (not included) of neighbouring texts that are handled at once."""
    start = size = 0
    for i, s in enumerate(streams):
        if size and size + len(s) > BLOCK:
            yield start, i
            start, size = i, 0
        size += len(s)
    if start < len(streams):
        yield start, len(streams)


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about ``CHUNK`` bytes in the column ``text`` and one row at least, so that what is made of a slice has the same size for any batch."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + CHUNK, "right")))
            yield batch.slice(start, end - start)
            start = end


def _packed(values: np.ndarray) -> bytes:
    """Numbers as bytes by place, compressed: those of sorted grams are mostly equal in the first places."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their numbers."""
    order = np.argsort(keys)
    keys = keys[order]
    first = _starts(keys)
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


def _part(flipped: np.ndarray, parts: int) -> np.ndarray:
    """The part of each gram, by its last five bytes; here and in what is handed on, the last byte of a gram comes first."""
    return (((flipped >> np.uint64(24)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)


def _near(flipped: np.ndarray) -> np.ndarray:
    """The nearest context bytes of each gram, by which the tree is dealt out."""
    return (flipped >> np.uint64(56 - 8 * TOP)) & np.uint64((1 << (8 * TOP)) - 1)


def _tree_part(flipped: np.ndarray, parts: int) -> np.ndarray:
    """The part of each gram, by its nearest context bytes, so that a part has whole groups."""
    return ((_near(flipped) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)


def _dealt(flipped: np.ndarray, parts: int, deal: Callable[[np.ndarray, int], np.ndarray] = _part) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that occurs, and where its grams are, in their order."""
    part = deal(flipped, parts).astype(np.int32)
    order = np.argsort(part, kind="stable")
    first = _starts(part[order])
    for at in np.split(order, first[1:]) if len(first) else []:
        yield int(part[at[0]]), at


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers of all packed runs of a column."""
    return np.concatenate([np.zeros(0, kind), *(_unpacked(b, kind) for b in column.to_pylist())])


#: Grams with their counts, as packed runs; a row has all grams with the same nearest context bytes, or several such groups.
_COUNTS = "grams binary, n binary"


def _count_rows(flipped: np.ndarray, n: np.ndarray) -> pa.Table:
    """Rows of whole groups of distinct grams, each of ``ROW`` grams or more but for the last."""
    near = _near(flipped)
    order = np.lexsort((flipped, near))
    first = _starts(near[order])
    row = np.zeros(len(first), np.int64)
    for i in range(1, len(first)):
        row[i] = first[i] if first[i] - row[i - 1] >= ROW else row[i - 1]
    runs = [at[np.argsort(flipped[at])] for at in np.split(order, np.unique(row)[1:])] if len(first) else []
    return pa.table({"grams": pa.array([_packed(flipped[at]) for at in runs], pa.binary()), "n": pa.array([_packed(n[at]) for at in runs], pa.binary())})


def _text_gram_counts(docs: DataFrame, held_out: Column, parts: int) -> DataFrame:
    """``grams, n`` (``_COUNTS``): all distinct grams of ``docs`` with their counts in documents that are not held out.

    Tasks count before they shuffle, up to ``FLUSH`` distinct grams at a time, and hand on compressed runs for each part. Parts by
    five bytes add them up, as these spread frequent contexts; the sums move, as such runs, to the rest of their group in the tree.
    """

    def runs(keys: np.ndarray, n: np.ndarray, deal: Callable[[np.ndarray, int], np.ndarray]) -> pa.Table:
        dealt = list(_dealt(keys, parts, deal))
        return pa.table({
            "part": pa.array([part for part, _ in dealt], pa.int32()),
            "grams": pa.array([_packed(keys[at]) for _, at in dealt], pa.binary()),
            "n": pa.array([_packed(n[at]) for _, at in dealt], pa.binary()),
        })

    def handed_on(pending: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.RecordBatch]:
        return runs(*_added(*(np.concatenate(c) for c in zip(*pending))), _part).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for held in (False, True):
                streams = [_stream(_tokens(t.as_py())) for t, h in zip(batch.column(0), batch.column(1).to_pylist()) if bool(h) == held]
                for start, end in _blocks(streams):
                    keys = _flipped_grams(streams[start:end])[0]
                    keys.sort()
                    first = _starts(keys)
                    times = np.zeros(len(first), np.int64) if held else np.diff(np.append(first, len(keys)))
                    pending.append((keys[first], times))
                    if sum(len(k) for k, _ in pending) >= FLUSH:
                        pending = [_added(*(np.concatenate(c) for c in zip(*pending)))]
                        if len(pending[0][0]) >= FLUSH // 2:
                            yield from handed_on(pending)
                            pending = []
        if pending:
            yield from handed_on(pending)

    def added(table: pa.Table) -> pa.Table:
        return runs(*_added(_joined(table.column("grams"), np.uint64), _joined(table.column("n"), np.int64)), _tree_part)

    def together(table: pa.Table) -> pa.Table:
        return _count_rows(_joined(table.column("grams"), np.uint64), _joined(table.column("n"), np.int64))

    schema = f"part int, {_COUNTS}"
    counted = docs.select("text", held_out.alias("held")).mapInArrow(thrifty(run), schema)
    return counted.groupBy("part").applyInArrow(added, schema).groupBy("part").applyInArrow(together, _COUNTS)


_WORDS = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def word_counts(docs: DataFrame, held_out: Column, flush: int = 200_000) -> DataFrame:
    """``word, n``: all distinct words of ``docs`` with their counts in documents that are not held out. The end of a text is the empty word.

    Tasks count before they shuffle, up to ``flush`` distinct words at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1).to_pylist()):
                words = [*_tokens(text.as_py()), b""]
                seen.update(dict.fromkeys(words, 0) if held else words)
                if len(seen) >= flush:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], schema=_WORDS)
                    seen.clear()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], schema=_WORDS)

    rows = docs.select("text", held_out.alias("held")).mapInArrow(thrifty(run), "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _gram_counts(words: DataFrame) -> DataFrame:
    """``grams, n`` (``_COUNTS``) of all grams of the distinct words, counted as often as the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, owner = grams(closed(batch.column(0).to_pylist()))
                found, inverse = np.unique(keys, return_inverse=True)
                n = np.bincount(inverse, batch.column(1).to_numpy()[owner].astype(float))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["gram", "n"])

    def together(table: pa.Table) -> pa.Table:
        return _count_rows(table.column("gram").to_numpy().view(np.uint64).byteswap(), table.column("n").to_numpy().astype(np.int64))

    counts = words.mapInArrow(thrifty(run), "gram long, n double").groupBy("gram").agg(F.sum("n").alias("n"))
    near = F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit((1 << (8 * TOP)) - 1))
    return counts.groupBy(near.alias("near")).applyInArrow(together, _COUNTS)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The grams, last byte first, and counts of one row of a table of counts (``_COUNTS``) after the other."""
    for batch in batches:
        for keys, n in zip(batch.column(0), batch.column(1)):
            yield _unpacked(keys.as_py(), np.uint64), _unpacked(n.as_py(), np.int64)


def _root(counts: DataFrame) -> Root:
    """The tree above ``TOP``, from the sums of the nodes there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _rows_of(batches):
            roots = subtree(keys.byteswap(), n.astype(float), TOP, mix=False)[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(roots["node"].view(np.int64)), *(pa.array(roots[c].astype(t)) for c, t in _NODE.items())], names=["node", *_NODE]
            )

    nodes = (
        counts.mapInArrow(thrifty(run), "node long, bit int, zeros double, ones double, log_pw double")
        .groupBy(F.col("node").bitwiseAND(F.lit(0xFFFF)).alias("node"), "bit")
        .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_pw").alias("log_pw"))
        .toPandas()
    )
    return Root(*(nodes[c].to_numpy(np.int64) for c in ("node", "bit")), *(nodes[c].to_numpy(float) for c in ("zeros", "ones", "log_pw")))


_NODE = {"bit": np.int32, "zeros": float, "ones": float, "log_pw": float}


def _levels(n: np.ndarray) -> np.ndarray:
    """Eight times the binary logarithm of counts, in whole numbers; -1 of none."""
    return np.where(n > 0, np.floor(8 * np.log2(np.maximum(n, 1))), -1).astype(np.int32)


def _log10(root: Root, flipped: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The log probability of each gram's last byte in its context; the grams are whole groups of the tree."""
    keys = flipped.byteswap()
    return root.log10(keys, subtree(keys, n.astype(float), TOP)[0])


def _gram_scores(counts: DataFrame) -> DataFrame:
    """``gram, log10``: the log probability of each gram's last byte in its context."""
    root = _root(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _rows_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array(keys.byteswap().view(np.int64)), pa.array(_log10(root, keys, n))], names=["gram", "log10"])

    return counts.mapInArrow(thrifty(run), "gram long, log10 double")


def _dealt_scores(counts: DataFrame, least: int, parts: int) -> DataFrame:
    """``part, keys, log10``: log probabilities of the grams of this level and above, without a part; of the others, in packed runs for each part."""
    root = _root(counts)

    def runs(keys: np.ndarray, found: list[tuple[int | None, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        packed = [(part, _packed(keys[at]), _packed(values)) for part, at, values in found]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*packed), (pa.int32(), pa.binary(), pa.binary()))], names=["part", "keys", "log10"]
        )

    def rest(pending: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, values = (np.concatenate(c) for c in zip(*pending))
        order = np.argsort(keys)
        keys, values = keys[order], values[order].astype(np.float32)
        return runs(keys, [(part, at, values[at]) for part, at in _dealt(keys, parts)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray]] = []
        for keys, n in _rows_of(batches):
            values, frequent = _log10(root, keys, n), _levels(n) >= least
            if frequent.any():
                yield runs(keys, [(None, frequent, values[frequent])])
            if not frequent.all():
                pending.append((keys[~frequent], values[~frequent]))
            if sum(len(k) for k, _ in pending) >= FLUSH // 4:
                yield rest(pending)
                pending = []
        if pending:
            yield rest(pending)

    return counts.mapInArrow(thrifty(run), "part int, keys binary, log10 binary")


def word_scores(words: DataFrame) -> DataFrame:
    """``word, n, score``: each distinct word (``word, n``) with its log10 probability by the tree of such words, as texts of their own.

    A word meets its grams under a 64-bit hash, as a very long one would else be repeated for each of them.
    """
    scores = _gram_scores(stored(_gram_counts(words), "grams"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, owner = grams(closed(batch.column(0).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array(owner)), pa.array(keys.view(np.int64))], names=["id", "gram"]
                )

    named = words.withColumn("id", F.xxhash64("word"))
    uses = named.select("word", "id").mapInArrow(thrifty(run), "id long, gram long")
    sums = uses.join(scores, "gram").groupBy("id").agg(F.sum("log10").alias("score"))
    return named.join(sums, "id").select("word", "n", "score")


def _frequent_level(counts: DataFrame) -> int:
    """The least level of the most frequent grams: whole levels, at most ``FREQUENT_GRAMS`` grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, n in _rows_of(batches):
            levels, times = np.unique(_levels(n), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(levels), pa.array(times.astype(np.int64))], names=["level", "n"])

    least, room = 0, FREQUENT_GRAMS
    # At most 8 * 63 rows.
    levels = counts.mapInArrow(thrifty(run), "level int, n long").where("level >= 0").groupBy("level").agg(F.sum("n").alias("n"))
    for row in sorted(levels.collect(), reverse=True):
        room -= row["n"]
        if room < 0:
            least = row["level"] + 1
            break
    return least


def _frequent_grams(scores: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequent grams, last byte first, with their log probabilities."""
    found = scores.where("part IS NULL").select("keys", "log10").toArrow()
    return _joined(found.column("keys"), np.uint64), _joined(found.column("log10"), float)


class Held:
    """Values of keys, found by a hash of the key."""

    BITS = 22

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        place = self._place(keys)
        order = np.argsort(place, kind="stable")
        self.keys, self.values = np.append(keys[order], np.uint64(0)), np.append(values[order], 0.0)
        self.first = np.searchsorted(place[order], np.arange((1 << self.BITS) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.first).max())

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are held, and their values (0 without one)."""
        place = self._place(keys)
        at, end = self.first[place], self.first[place + 1]
        hit, values = np.zeros(len(keys), bool), np.zeros(len(keys))
        open_ = np.flatnonzero(at < end)
        at, end, wanted = at[open_], end[open_], keys[open_]
        for _ in range(self.deepest):
            same = self.keys[at] == wanted
            found = open_[same]
            hit[found], values[found] = True, self.values[at[same]]
            at += 1
            more = np.flatnonzero(~same & (at < end))
            if not len(more):
                break
            open_, at, end, wanted = open_[more], at[more], end[more], wanted[more]
        return hit, values


def _with_rest_sums(found: DataFrame, scores: DataFrame) -> DataFrame:
    """Of ``found`` (``_SCORED``), the rows of documents as they are, and for each run of grams the sums of their log probabilities (``part, keys, log10``).

    A part at a time. All go through the one exchange, so that the runs, which are many times the sums, are not written besides.
    """

    def of_part(left: pa.Table, right: pa.Table) -> pa.Table:
        known, values = _joined(right.column("keys"), np.uint64), _joined(right.column("log10"), np.float32)
        order = np.argsort(known)
        known, values = known[order], values[order]
        is_run = pc.is_valid(left.column("grams"))
        runs, rows = left.filter(is_run), left.filter(pc.invert(is_run))
        owners, sums = [], []
        for keys, owner in zip(runs.column("grams"), runs.column("owners")):
            owner = _unpacked(owner.as_py(), np.uint32)
            total = np.bincount(owner, values[np.searchsorted(known, _unpacked(keys.as_py(), np.uint64))])
            at = np.flatnonzero(total)
            owners.append(_packed(at.astype(np.uint32)))
            sums.append(_packed(total[at].astype(np.float32)))
        columns = {"chunk": runs.column("chunk"), "owners": pa.array(owners, pa.binary()), "sums": pa.array(sums, pa.binary())}
        own = pa.table([columns.get(f.name, pa.nulls(len(owners), f.type)) for f in _SUMMED], schema=_SUMMED)
        of_rows = pa.table([rows.column(f.name) if f.name in _DOCUMENT else pa.nulls(len(rows), f.type) for f in _SUMMED], schema=_SUMMED)
        return pa.concat_tables([of_rows, own])

    return found.groupBy("part").cogroup(scores.groupBy("part")).applyInArrow(of_part, f"{_DOCUMENT_SCHEMA}, chunk long, owners binary, sums binary")


def _rest_scores(sums: DataFrame) -> DataFrame:
    """``row, tree_rest``: the sums of the runs (``chunk, owners, sums``), added up."""

    def of_chunk(table: pa.Table) -> pa.Table:
        owner = np.concatenate([_unpacked(b, np.uint32) for b in table.column("owners").to_pylist()])
        total = np.bincount(owner, np.concatenate([_unpacked(b, np.float32) for b in table.column("sums").to_pylist()]))
        at = np.flatnonzero(total)
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"row": pa.array((chunk << _ROW_BITS) + at), "tree_rest": pa.array(total[at])})

    return sums.groupBy("chunk").applyInArrow(of_chunk, "row long, tree_rest double")


#: A row is known by the task, the slice of an Arrow batch in it (its chunk), and its place there.
_BATCH_BITS, _ROW_BITS = 20, 24
_DOCUMENT = {
    "doc_id": pa.int64(), "held_out": pa.bool_(), "row": pa.int64(), "n_tokens": pa.int64(), "n_bytes": pa.int64(),
    "known": pa.int64(), "base": pa.float64(), "model": pa.float64(),
    "rest": pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())])),
}
_DOCUMENT_SCHEMA = (
    "doc_id long, held_out boolean, row long, n_tokens long, n_bytes long, known long, base double, model double, "
    "rest array<struct<word binary, times long>>"
)
#: Rows of documents, and runs of grams that have ``grams``; each goes to a part.
_SCORED = pa.schema([*_DOCUMENT.items(), ("part", pa.int32()), ("chunk", pa.int64()), ("grams", pa.binary()), ("owners", pa.binary())])
#: Rows of documents, and sums of runs.
_SUMMED = pa.schema([*_DOCUMENT.items(), ("chunk", pa.int64()), ("owners", pa.binary()), ("sums", pa.binary())])


def _scored(columns: dict[str, pa.Array], size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in _SCORED], schema=_SCORED)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    ``score`` is the log10 probability of the text by the context tree, ``base_score`` that of add-one word frequencies, both from
    the documents that are not ``held_out``. Null and empty texts have one token, the end. Rows that repeat are counted and scored
    each; null ids pass through; other columns are ignored. With nothing to learn from, the tree predicts each bit with one half.

    Each task scores its texts by the frequent grams and words, which it holds. The others are handed on, grams in compressed runs
    for the part that has their scores.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    parts = max(PARTS, size // PART_BYTES)
    counts = stored(_text_gram_counts(docs, held_out, parts), "grams")
    scores = stored(_dealt_scores(counts, _frequent_level(counts), parts), "gram_scores")
    words = stored(word_counts(docs, held_out), "words")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)).alias("v")).first()
    total, room = sums["n"], float(sums["n"] + sums["v"] + 1)
    base = F.log10((F.col("n") + 1) / F.lit(room))
    valued = words.select("word", (F.col("n") > 0).cast("long").alias("known"), base.alias("base"))
    frequent = (
        words.where((F.octet_length("word") <= FREQUENT_BYTES) & (F.col("n") > 0) & (F.col("n") >= FREQUENT_SHARE * total))
        .select("word", (F.col("n") > 0).cast("long"), base).toPandas()
    )
    held_words = {bytes(w): v for w, *v in frequent.itertuples(index=False)}
    context = docs.sparkSession.sparkContext
    shared, shared_grams = context.broadcast(held_words), context.broadcast(Held(*_frequent_grams(scores)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = {w: (int(k), float(b)) for w, (k, b) in shared.value.items()}
        number = {w: i for i, w in enumerate(values)}
        table = np.array([*values.values(), (0.0, 0.0)])
        held_grams = shared_grams.value
        none, task = len(values), TaskContext.get().partitionId()
        for k, batch in enumerate(_slices(batches, 2)):
            found, rest, streams = [], [], []
            for text in batch.column(2):
                tokens = _tokens(text.as_py())
                streams.append(_stream(tokens))
                tokens.append(b"")
                at = np.fromiter((number.get(t, none) for t in tokens), np.int64, len(tokens))
                sums = table[at].sum(axis=0)
                others = Counter([tokens[i] for i in np.flatnonzero(at == none)])
                found.append((len(tokens), len(streams[-1]), *sums))
                rest.append([{"word": w, "times": n} for w, n in others.items()])
            if not found:
                continue
            model, others = np.zeros(len(streams)), []
            for start, end in _blocks(streams):
                keys, owner = _flipped_grams(streams[start:end])
                hit, value = held_grams.find(keys)
                owner += start
                model += np.bincount(owner, value, len(streams))
                unknown = np.flatnonzero(~hit)
                keys, owner = keys[unknown], owner[unknown].astype(np.uint32)
                order = np.argsort(keys)
                others.append((keys[order], owner[order]))
            chunk = task << _BATCH_BITS | k
            n_tokens, n_bytes, known, base_sum = (np.array(c) for c in zip(*found))
            yield _scored({
                "doc_id": batch.column(0), "held_out": batch.column(1), "row": pa.array((chunk << _ROW_BITS) + np.arange(len(streams))),
                "n_tokens": pa.array(n_tokens, pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64()), "known": pa.array(known.astype(np.int64)),
                "base": pa.array(base_sum), "model": pa.array(model), "rest": pa.array(rest, _DOCUMENT["rest"]),
                "part": pa.array([(task + k) % parts] * len(streams), pa.int32()),
            }, len(streams))
            keys, owner = (np.concatenate(c) for c in zip(*others))
            for part, at in _dealt(keys, parts):
                yield _scored({
                    "part": pa.array([part], pa.int32()), "chunk": pa.array([chunk], pa.int64()),
                    "grams": pa.array([_packed(keys[at])], pa.binary()), "owners": pa.array([_packed(owner[at])], pa.binary()),
                }, 1)

    found = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text").mapInArrow(
        thrifty(run),
        f"{_DOCUMENT_SCHEMA}, part int, chunk long, grams binary, owners binary",
    )
    found = stored(_with_rest_sums(found, scores.where("part IS NOT NULL")), "document_sums")
    rows = found.where("sums IS NULL").select(*_DOCUMENT)
    rest = (
        rows.select("row", F.explode("rest").alias("x")).select("row", "x.word", "x.times").join(valued, "word")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("known")).alias("known_rest"), F.sum(F.col("times") * F.col("base")).alias("base_rest"))
    )
    grams_rest = _rest_scores(found.where("sums IS NOT NULL").select("chunk", "owners", "sums"))

    def plus(column: str, more: str) -> Column:
        return F.col(column) + F.coalesce(F.col(more), F.lit(0))

    out = rows.drop("rest").join(rest, "row", "left").join(grams_rest, "row", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        plus("known", "known_rest").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        plus("base", "base_rest").alias("base_score"),
        plus("model", "tree_rest").alias("score"),
        (-plus("model", "tree_rest") * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
