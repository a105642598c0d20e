"""How far the sources of a language diverge in their terms, by single-pass in-memory indexing.

Each task reads texts once and gathers postings in memory: occurrences and documents of a term in one language and source. When memory is
full, the block is spilled as a run that is sorted by term and cut into chunks, dealt to shards by a hash of language and term. A
shard's chunks reach one task in the order of their first terms, where a heap merges the runs into frequencies, holding one
chunk of each run. The terms a language keeps are written; probabilities follow by joins.

A pair of sources sums a value over all kept terms of its language, most of which neither has. With ``f(p, q)`` that value and ``p0`` the
probability of a term that does not occur, the sum is ``V f(p0, q0)``, plus a part for the terms of one source alone, which only depends on
how many terms it has of each count, plus a correction for each term that both have. The corrections are streamed from the merged terms.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playledger.llm.common import stored

#: Bytes of UTF-8 that belong to terms: letters of ASCII, of which A-Z become a-z, and all beyond ASCII. Others become spaces.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Documents that a kept term has at least, and the ranks reported of the terms of a group.
LEAST_DOCS, RANKS = 3, 200
SCALE = 1_000_000_000
#: Bytes of postings that a task holds, by estimate; terms of a chunk; bytes of text that are split into terms at once.
BLOCK_BYTES, CHUNK, SLICE = 128_000_000, 4096, 1 << 16
_ENTRY_BYTES = 300
#: Sources of a term that are merged at once.
SOURCES = 10_000
#: Parts into which the terms of one language are dealt where all its sources meet them.
SALTS = 16

_RUN = (
    "shard int, lang binary, first binary, terms array<binary>, buckets array<int>, sizes array<int>, "
    "sources array<binary>, counts array<bigint>, docs array<bigint>"
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in parts; long texts are cut between terms."""
    text = text.translate(_TABLE)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _first(term: bytes, bucket: int) -> bytes:
    """Sorts as the term and then the bucket; no term holds a byte as low as the one between them."""
    return term + b"\x00" + bucket.to_bytes(4, "big")


def _run(lang: bytes, groups: dict[bytes, tuple[Counter, Counter]], shards: int, buckets: int, chunk_rows: int) -> pa.RecordBatch:
    """The postings of one language as a run: sorted by shard, term, bucket and source, a row for each chunk."""
    names = sorted(groups)
    terms, counts, docs = [], [], []
    for name in names:
        count, documents = groups[name]
        terms += count
        counts += count.values()
        docs += map(documents.__getitem__, count)
    of_source = np.repeat(np.arange(len(names)), [len(groups[name][0]) for name in names])
    coded = pa.array(terms, pa.binary()).dictionary_encode()
    words = coded.dictionary
    by_word = pc.sort_indices(words).to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[by_word] = np.arange(len(words))
    shard = np.array([crc32(w, crc32(lang)) % shards for w in words.to_pylist()])
    code = coded.indices.to_numpy()
    bucket = np.array([crc32(name) % buckets for name in names])[of_source]
    order = np.lexsort((of_source, bucket, rank[code], shard[code]))
    code, bucket, of_source = code[order], bucket[order], of_source[order]
    starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (bucket[1:] != bucket[:-1])])
    key_shard, key_code = shard[code[starts]], code[starts]
    # A chunk begins with each shard, and after so many terms.
    within = np.arange(len(starts)) - np.searchsorted(key_shard, key_shard)
    chunks = np.flatnonzero(within % chunk_rows == 0)
    key_offsets = pa.array(np.append(chunks, len(starts)), pa.int32())
    row_offsets = pa.array(np.append(starts[chunks], len(code)), pa.int32())
    key_terms = words.take(pa.array(key_code))
    first = [_first(key_terms[int(i)].as_py(), int(bucket[starts[i]])) for i in chunks]

    def listed(offsets: pa.Array, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(offsets, values)

    return pa.RecordBatch.from_arrays(
        [
            pa.array(key_shard[chunks], pa.int32()),
            pa.array([lang] * len(chunks), pa.binary()),
            pa.array(first, pa.binary()),
            listed(key_offsets, key_terms),
            listed(key_offsets, pa.array(bucket[starts], pa.int32())),
            listed(key_offsets, pa.array(np.diff(np.append(starts, len(code))), pa.int32())),
            listed(row_offsets, pa.array(names, pa.binary()).take(pa.array(of_source))),
            listed(row_offsets, pa.array(np.array(counts, np.int64)[order])),
            listed(row_offsets, pa.array(np.array(docs, np.int64)[order])),
        ],
        names=["shard", "lang", "first", "terms", "buckets", "sizes", "sources", "counts", "docs"],
    )


def runs(docs: DataFrame, shards: int, buckets: int, block_bytes: int = BLOCK_BYTES, chunk_rows: int = CHUNK) -> DataFrame:
    """Chunks of term-sorted runs. ``first`` is the sort key of the first term of a chunk, beside its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings: dict[bytes, dict[bytes, tuple[Counter, Counter]]] = {}
        held = 0

        def spill() -> Iterator[pa.RecordBatch]:
            for lang in list(postings):
                groups = {name: found for name, found in postings.pop(lang).items() if found[0]}
                made = _run(lang, groups, shards, buckets, chunk_rows) if groups else ()
                for at in range(0, len(made), 64):
                    yield made.slice(at, 64)

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).cast(pa.binary()) for i in range(3))):
                text = text.as_py()
                if not text:
                    continue
                counts, documents = postings.setdefault(lang.as_py(), {}).setdefault(source.as_py(), (Counter(), Counter()))
                before, once = len(counts), set()
                for part in terms_of(text):
                    counts.update(part)
                    once.update(part)
                documents.update(once)
                held += (len(counts) - before) * _ENTRY_BYTES
                if held > block_bytes:
                    yield from spill()
                    held = 0
        yield from spill()

    return docs.select("lang", "source", "text").mapInArrow(run, _RUN)


class Chunk:
    """A chunk of a run as lists, with the place that the merge has reached."""

    def __init__(self, shard: int, lang: bytes, terms: list, buckets: list, sizes: list, sources: list, counts: list, docs: list) -> None:
        self.keys = [(shard, lang, term, bucket) for term, bucket in zip(terms, buckets)]
        self.sizes, self.sources, self.counts, self.docs = sizes, sources, counts, docs
        self.at = self.row = 0


def merge(chunks: Iterator[Chunk]) -> Iterator[list[tuple[bytes, bytes, list, list[int]]]]:
    """``lang, term, sources, counts`` of kept terms, and in the end the total of each as that of no source.

    The chunks come by shard, language and first term, so a term can leave the heap once no later chunk begins before it.
    Every source of a term has a document with it, so less than three are held back until it is known that the term is kept.
    """
    heap: list = []
    key: tuple | None = None
    sums: dict[bytes, int] = {}
    pending: dict[bytes, int] = {}
    docs = total = number = 0
    found: list = []
    chunk = next(chunks, None)
    while chunk or heap:
        limit = chunk.keys[0] if chunk else None
        while heap and (limit is None or heap[0][0] < limit):
            now, order, own = heap[0]
            at, row = own.at, own.row
            end = row + own.sizes[at]
            if at + 1 < len(own.keys):
                own.at, own.row = at + 1, end
                heapq.heapreplace(heap, (own.keys[at + 1], order, own))
            else:
                heapq.heappop(heap)
            if now != key:
                if sums:
                    if docs >= LEAST_DOCS:
                        total += sum(sums.values())
                        pending.update(sums)
                        found.append((key[1], key[2], list(pending), list(pending.values())))
                        pending = {}
                    else:
                        total += sum(sums.values())
                        pending.update(sums)
                    sums = {}
                if key and now[:3] != key[:3]:
                    if docs >= LEAST_DOCS:
                        found.append((key[1], key[2], [None], [total]))
                    pending, docs, total = {}, 0, 0
                key = now
            if end == row + 1:
                docs += own.docs[row]
                source = own.sources[row]
                sums[source] = sums.get(source, 0) + own.counts[row]
            else:
                docs += sum(own.docs[row:end])
                if sums:
                    for source, count in zip(own.sources[row:end], own.counts[row:end]):
                        sums[source] = sums.get(source, 0) + count
                else:
                    sums = dict(zip(own.sources[row:end], own.counts[row:end]))
        if chunk:
            number += 1
            heapq.heappush(heap, (limit, number, chunk))
            chunk = next(chunks, None)
        yield found
        found = []
    if key and docs >= LEAST_DOCS:
        total += sum(sums.values())
        pending.update(sums)
        yield [(key[1], key[2], list(pending), list(pending.values())), (key[1], key[2], [None], [total])]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        column = {name: batch.column(name) for name in batch.schema.names}
        for i in range(len(batch)):
            numbers = [column[name][i].values.to_numpy().tolist() for name in ("buckets", "sizes", "counts", "docs")]
            coded = column["sources"][i].values.dictionary_encode()
            names = coded.dictionary.to_pylist()
            sources = list(map(names.__getitem__, coded.indices.to_numpy().tolist()))
            shard, lang, terms = (column[name][i].as_py() for name in ("shard", "lang", "terms"))
            yield Chunk(shard, lang, terms, numbers[0], numbers[1], sources, numbers[2], numbers[3])


def frequencies(chunks: DataFrame, shards: int) -> DataFrame:
    """``lang, term, source, count`` of the terms that are kept; without a source, their total in the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], [], []]
        for found in merge(_chunks(batches)):
            for lang, term, sources, counts in found:
                columns[0] += [lang] * len(sources)
                columns[1] += [term] * len(sources)
                columns[2] += sources
                columns[3] += counts
            if len(columns[0]) >= 20_000:
                yield _rows(columns)
                columns = [[], [], [], []]
        if columns[0]:
            yield _rows(columns)

    sorted_runs = chunks.repartition(shards, "shard").sortWithinPartitions("shard", "lang", "first")
    return sorted_runs.mapInArrow(run, "lang string, term string, source string, count long")


def _rows(columns: list[list]) -> pa.RecordBatch:
    texts = [pa.array(c, pa.binary()).cast(pa.string()) for c in columns[:3]]
    return pa.RecordBatch.from_arrays([*texts, pa.array(columns[3], pa.int64())], names=["lang", "term", "source", "count"])


def share(count: Column, n: Column, v: Column) -> Column:
    """``1 + floor(1e9 (count + 1) / (n + v))``, exact at any count."""
    count, whole = (x.cast("decimal(20,0)") for x in (count, n + v))
    return F.call_function("div", (count + 1) * F.lit(SCALE).cast("decimal(10,0)"), whole) + 1


def value(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``; shares are at most 1e9 + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pairs(who: np.ndarray, p: np.ndarray, p0: np.ndarray, first: np.ndarray, sums: np.ndarray, slice_rows: int = 1 << 18) -> None:
    """Adds to ``sums[source, other]`` what each term that both have changes. ``first``: where each term begins."""
    size = np.diff(np.append(first, len(who)))
    mine = np.repeat(size, size)
    start = np.repeat(first, size)
    ends = np.cumsum(mine)
    at = 0
    while at < len(who):
        done = int(ends[at] - mine[at])
        until = max(at + 1, int(np.searchsorted(ends, done + slice_rows)))
        x = np.repeat(np.arange(at, until), mine[at:until])
        y = np.arange(len(x)) - np.repeat(ends[at:until] - mine[at:until] - done, mine[at:until]) + np.repeat(start[at:until], mine[at:until])
        a, b, a0, b0 = p[x], p[y], p0[x], p0[y]
        np.add.at(sums, (who[x], who[y]), _value(a, b) - _value(a, b0) - _value(a0, b) + _value(a0, b0))
        at = until


def corrections(rows: DataFrame) -> DataFrame:
    """``lang, source, item, part``: what the terms that both sources have change in the sum of their pair.

    ``rows``: ``lang, term, source, p, p0``, one task having all rows of a term. A task adds up the pairs of the sources that it meets in some
    ten thousand rows, and passes on one row for each pair of these whenever they become too many to hold. The pairs of a term are made in slices.
    """
    held_sources = 512

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang: str | None = None
        place: dict[str, int] = {}
        sums = np.zeros((held_sources, held_sources), np.int64)

        def flush(names: list[str], found: np.ndarray) -> Iterator[pa.RecordBatch]:
            np.fill_diagonal(found, 0)
            for start in range(0, len(names), 64):
                x, y = np.nonzero(found[start : start + 64])
                if len(x):
                    each = pa.array(names, pa.string())
                    columns = [pa.array([lang] * len(x)), each.take(pa.array(x + start)), each.take(pa.array(y)), pa.array(found[start + x, y])]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "part"])

        def whole_terms() -> Iterator[pa.RecordBatch]:
            rest = None
            for batch in batches:
                both = batch if rest is None else pa.concat_batches([rest, batch])
                last = both.slice(len(both) - 1)
                same = pc.and_(pc.equal(both.column(0), last.column(0)[0]), pc.equal(both.column(1), last.column(1)[0]))
                cut = int(pc.index(same, True).as_py())
                rest = both.slice(cut)
                if cut:
                    yield both.slice(0, cut)
            if rest is not None:
                yield rest

        for part in whole_terms():
            langs = part.column(0).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, langs[1:] != langs[:-1], True])
            for start, end in zip(edges[:-1], edges[1:]):
                some = part.slice(start, end - start)
                coded = some.column(2).dictionary_encode()
                names = coded.dictionary.to_pylist()
                if langs[start] != lang or len(place) + len(names) > held_sources:
                    yield from flush(list(place), sums)
                    sums[:], lang, place = 0, langs[start], {}
                terms = some.column(1)
                first = np.flatnonzero(np.r_[True, pc.not_equal(terms.slice(1), terms.slice(0, len(terms) - 1)).to_numpy(zero_copy_only=False)])
                p, p0 = (some.column(i).to_numpy() for i in (3, 4))
                codes = coded.indices.to_numpy()
                if len(names) <= held_sources:
                    where = np.array([place.setdefault(name, len(place)) for name in names])
                    _pairs(where[codes], p, p0, first, sums)
                    continue
                # More sources than are held: block beside block.
                for low in range(0, len(names), held_sources // 2):
                    for high in range(0, len(names), held_sources // 2):
                        rows_of = [(codes >= x) & (codes < x + held_sources // 2) for x in (low, high)]
                        yield from flush_block(names, codes, p, p0, first, rows_of, (low, high), flush)
        yield from flush(list(place), sums)

    def flush_block(names, codes, p, p0, first, rows_of, at, flush):
        """The pairs of two blocks of sources; of one block with itself once."""
        low, high = at
        if high < low:
            return
        keep = rows_of[0] | rows_of[1]
        term = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(codes))))[keep]
        if not len(term):
            return
        half = held_sources // 2
        code = codes[keep]
        local = np.where((code >= low) & (code < low + half), code - low, code - high + half)
        sums = np.zeros((held_sources, held_sources), np.int64)
        _pairs(local, p[keep], p0[keep], np.flatnonzero(np.r_[True, term[1:] != term[:-1]]), sums)
        if low != high:  # those within a block have their own turn
            sums[:half, :half] = 0
            sums[half:, half:] = 0
        mine = names[low : low + half]
        yield from flush(mine + [""] * (half - len(mine)) + names[high : high + half], sums)

    dealt = rows.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(run, "lang string, source string, item string, part long")


def audit(docs: DataFrame, shards: int | None = None, block_bytes: int = BLOCK_BYTES, chunk_rows: int = CHUNK) -> DataFrame:
    """``lang, source, part, item, value, rank`` (parts ``pair`` and ``term``), as the contract of the query says.

    ``docs``: ``text, lang, source``; other columns are ignored. Null counts as empty text, language or source; an empty or blank text has no
    terms, its group is still reported. Rows that repeat a document count each. A very long text is read in slices of terms. Equal values are ranked by
    item. An empty table gives no rows.

    A language, source or term with a third of all rows is added up in each task before it moves: a run has one row for each term and
    source. ``shards``: by default, as many as the session has shuffle partitions; ``block_bytes``: what a task holds before it spills.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blank = F.lit("")
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("lang", "source", "text")])
    occurring = stored(texts.select("lang", "source").distinct(), "term_sources")
    most = occurring.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    made = runs(texts, shards, 1 + most // SOURCES, block_bytes, chunk_rows)
    kept = stored(frequencies(made, shards), "term_frequencies")
    of_lang = kept.where("source IS NULL").groupBy("lang").agg(F.count("*").alias("v"), F.sum("count").alias("n_lang"))
    of_source = kept.where("source IS NOT NULL").groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = (
        occurring.join(of_source, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "n_lang")])
    )
    nothing = F.lit(0).cast("long")
    # Without kept terms there is nothing to share out.
    groups = stored(groups.withColumn("p0", F.when(F.col("v") > 0, share(nothing, F.col("n"), F.col("v")))), "term_groups")

    in_lang = F.sum("count").over(Window.partitionBy("lang", "term")).alias("in_lang")
    found = kept.where("source IS NOT NULL").join(groups, ["lang", "source"])
    rows = stored(
        found.select("lang", "term", "source", "count", "n", "v", "n_lang", "p0", in_lang).select(
            "lang", "term", "source", "count", "p0",
            share(F.col("count"), F.col("n"), F.col("v")).alias("p"), share(F.col("in_lang"), F.col("n_lang"), F.col("v")).alias("q"),
        ),
        "term_shares",
    )

    def ranked(found: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
        return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    terms = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), value(F.col("p"), F.col("q")).alias("value"))

    # How many terms a source has of each count, beside every other source of the language. Dealt out by count, so that one language is no single task.
    salt = F.pmod(F.xxhash64("source", "count"), F.lit(SALTS)).cast("int").alias("salt")
    counts = rows.groupBy("lang", "source", "count", "p", "p0").agg(F.count("*").alias("terms")).select("*", salt)
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    beside = counts.join(others, ["lang", "salt"]).where("source <> item")
    one_sided = beside.groupBy("lang", "source", "item").agg(
        F.sum(F.col("terms") * (value(F.col("p"), F.col("q0")) - value(F.col("p0"), F.col("q0")))).alias("mine"),
        F.sum(F.col("terms") * (value(F.col("q0"), F.col("p")) - value(F.col("q0"), F.col("p0")))).alias("theirs"),
    )
    own = one_sided.select("lang", "source", "item", F.col("mine").alias("part"))
    swapped = one_sided.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("theirs").alias("part"))
    left = groups.select("lang", "source", "v", "p0", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.pmod(F.xxhash64("source"), F.lit(SALTS)).cast("int").alias("salt"))
    pairs = left.join(right, ["lang", "salt"]).where("source <> item")
    base = pairs.select("lang", "source", "item", F.coalesce(F.col("v") * value(F.col("p0"), F.col("q0")), nothing).alias("part"))
    parts = base.unionByName(own).unionByName(swapped).unionByName(corrections(rows))
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("part").alias("value"))
    limited = ranked(terms, "term").where(F.col("rank") <= RANKS)
    return ranked(sums, "pair").unionByName(limited)
