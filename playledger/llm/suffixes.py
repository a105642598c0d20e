"""Repeated passages by a sparse suffix array.

Of all suffixes of all texts, only those are kept that start at a minimiser: the gram of words with the least hash among
``min_words - gram + 1`` consecutive ones. The choice depends on the content alone, so every passage of ``min_words`` words
that occurs twice holds a minimiser at the same place in both: the one that owns it. All passages that a minimiser owns make up
one stretch of text around it, its span.

* Minimisers with equal spans are one class, of which one stands for all.
* A passage has ``(min_words - gram) / 2`` more words at one side of its gram at least, so a class is compared with others only if
  the gram with that many words to its right, or to its left, stands in another class.
* The suffixes of these classes are sorted, and neighbours compared: to the right from the gram, and to the left before it. For
  each offset of a passage from its gram, neighbours that agree far enough to the right make up a run. If they all agree to the left, too, or
  none does, the run is settled. Else other suffixes may stand between equal passages; those passages are sorted
  once more by themselves.

Words are compared in lower case (A-Z), so the white space between them plays no part. Spans and passages are known by a
64-bit hash beside that of their gram; words of neighbours are compared by 32 bits each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playledger.llm.common import SPACE_CHARS, free_name, is_taken, process_cache, slot, stored, taken_slots, thrifty

_WORD = re.compile(f"[^{SPACE_CHARS}]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Suffixes that a task compares at once. What goes on beyond them is sorted once more.
_BLOCK = 4096


@dataclass(frozen=True)
class Passage:
    """The shortest passage that counts, and the words of a gram."""

    min_words: int = 50
    gram: int = 10

    @property
    def window(self) -> int:
        return self.min_words - self.gram + 1

    @property
    def half(self) -> int:
        """Words that every passage has at one side of its gram at least."""
        return (self.min_words - self.gram) // 2


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _grams(words: np.ndarray, p: Passage) -> np.ndarray:
    count = len(words) - p.gram + 1
    grams = np.zeros(count, np.uint64)
    for k in range(p.gram):
        grams = (grams ^ words[k : k + count]) * _MIX
        grams ^= grams >> np.uint64(29)
    return grams


@dataclass(frozen=True)
class Marks:
    """The minimisers of a text: position, gram, and the passages that they own, from ``pos - left`` to ``pos - right``."""

    pos: np.ndarray
    gram: np.ndarray
    left: np.ndarray
    right: np.ndarray


def minimisers(words: np.ndarray, p: Passage) -> Marks:
    """None in a text shorter than a passage."""
    if len(words) < p.min_words:
        return Marks(*(np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64)))
    grams = _grams(words, p)
    views = np.lib.stride_tricks.sliding_window_view(grams, p.window)
    owners = views.argmin(axis=1) + np.arange(len(views))
    pos, first, n = np.unique(owners, return_index=True, return_counts=True)
    return Marks(pos, grams[pos], pos - first, pos - first - n + 1)


_MARK = {"gram": "long", "span": "long", "before": "long", "after": "long", "doc": "long", "row": "long", "pos": "int", "left": "int", "right": "int"}


def _marks(texts: DataFrame, p: Passage) -> DataFrame:
    """All minimisers: the hash of each one's span, and of its gram with ``half`` words before, and after; null if no passage it owns has them."""

    def of_text(text: str | None) -> tuple[np.ndarray, ...]:
        words = word_hashes(text)
        m = minimisers(words, p)
        raw = words.tobytes()
        digest = xxhash.xxh3_64_intdigest
        span, before, after = (np.zeros(len(m.pos), np.uint64) for _ in range(3))
        for i, (pos, left, right) in enumerate(zip(m.pos.tolist(), m.left.tolist(), m.right.tolist())):
            span[i] = digest(raw[8 * (pos - left) : 8 * (pos - right + p.min_words)], left)
            if left >= p.half:
                before[i] = digest(raw[8 * (pos - p.half) : 8 * (pos + p.gram)], 1)
            if right <= p.min_words - p.gram - p.half:
                after[i] = digest(raw[8 * pos : 8 * (pos + p.gram + p.half)], 2)
        return m.gram.view(np.int64), span.view(np.int64), before.view(np.int64), after.view(np.int64), m.pos, m.left, m.right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_cache("passages", dict)
        for batch in batches:
            found = [of_text(t.as_py()) for t in batch.column(2)]
            if not found:
                continue
            of = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            gram, span, before, after, pos, left, right = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram),
                    pa.array(span),
                    pa.array(before, mask=before == 0),
                    pa.array(after, mask=after == 0),
                    batch.column(0).take(of),
                    batch.column(1).take(of),
                    *(pa.array(x.astype(np.int32)) for x in (pos, left, right)),
                ],
                names=list(_MARK),
            )

    return texts.mapInArrow(thrifty(run), ", ".join(f"{n} {t}" for n, t in _MARK.items()))


_CONTEXT = "gram long, span long, after binary, before binary, doc long, row long, pos int, several boolean"


def _contexts(texts: DataFrame, classes: DataFrame, p: Passage) -> DataFrame:
    """The words of each class's span, from its gram on, and those before it, nearest first."""
    spots = classes.select(
        F.col("least.*"), F.struct("least.pos", "gram", "span", "left", "right", "several").alias("spot")
    ).groupBy("doc", "row").agg(F.collect_list("spot").alias("spots"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, 64) for k in range(0, whole.num_rows, 64)):
                rows = []
                for doc, row, text, spots in zip(*(c.to_pylist() for c in batch.columns)):
                    short = (word_hashes(text) >> np.uint64(32)).astype(">u4")
                    for s in spots:
                        pos = s["pos"]
                        after = short[pos : pos - s["right"] + p.min_words].tobytes()
                        before = short[pos - s["left"] : pos][::-1].tobytes()
                        rows.append((s["gram"], s["span"], after, before, doc, row, pos, s["several"]))
                if rows:
                    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
                    names = [n.split()[0] for n in _CONTEXT.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    # Rows that repeat id and text are one document.
    joined = texts.join(spots, ["doc", "row"]).dropDuplicates(["doc", "row"]).select("doc", "row", "text", "spots")
    return joined.mapInArrow(thrifty(run), _CONTEXT)


def _agree(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal leading words of each pair of rows, at most ``most``."""
    differ = x != y
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
    return np.minimum(first, most)


def _matrix(column: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(b"".join(c.ljust(4 * width, b"\0") for c in column), ">u4").reshape(-1, width)
    return words, np.array([len(c) // 4 for c in column])


def compare(gram: np.ndarray, after: list[bytes], before: list[bytes], place: np.ndarray, several: np.ndarray, p: Passage) -> list[tuple]:
    """What neighbours among sorted suffixes share: ``(suffix, least, most, first of the run, repeated, passage)``.

    ``least`` to ``most`` are offsets of passages from the gram. The first of the run, by ``place``, is the least suffix with
    the same passage. Where a run is not settled, the hash of the passage is given, and runs are to be joined by it.
    """
    n = len(gram)
    right, right_words = _matrix(after, p.min_words)
    left, left_words = _matrix(before, p.min_words)
    same = gram[1:] == gram[:-1]
    to_right = np.where(same, _agree(right[1:], right[:-1], np.minimum(right_words[1:], right_words[:-1])), 0)
    to_left = np.where(same, _agree(left[1:], left[:-1], np.minimum(left_words[1:], left_words[:-1])), 0)
    out: list[tuple] = []
    # Of each suffix, the offsets that have the same outcome so far.
    held: dict[int, tuple] = {}
    for d in range(p.window):
        owns = np.flatnonzero((right_words >= p.min_words - d) & (left_words >= d))
        if not len(owns):
            continue
        near = to_right >= p.min_words - d
        run = np.concatenate([[0], np.cumsum(~near)])
        part = np.concatenate([[0], np.cumsum(~(near & (to_left >= d)))])
        mine, inverse, size = np.unique(part[owns], return_inverse=True, return_counts=True)
        first = np.full(len(mine), n, np.int64)
        np.minimum.at(first, inverse, place[owns])
        some = np.zeros(len(mine), bool)
        np.logical_or.at(some, inverse, several[owns])
        run_of = np.zeros(len(mine), np.int64)
        run_of[inverse] = run[owns]
        parts = np.bincount(run_of, minlength=run[-1] + 1)
        # What touches an end may go on beyond it.
        settled = (parts[run_of] == 1) & (run_of != 0) & (run_of != run[-1])
        again = (size > 1) | some
        for i, k in zip(owns.tolist(), inverse.tolist()):
            if settled[k]:
                if again[k]:
                    now = (int(first[k]), True)
                    old = held.get(i)
                    if old and old[1] == d - 1 and old[2] == now[0]:
                        held[i] = (old[0], d, now[0])
                    else:
                        if old:
                            out.append((i, *old, True, None))
                        held[i] = (d, d, now[0])
            else:
                key = xxhash.xxh3_64_intdigest(before[i][: 4 * d] + after[i][: 4 * (p.min_words - d)], d)
                out.append((i, d, d, int(first[k]), bool(again[k]), key - (1 << 64) if key >> 63 else key))
    out += [(i, *old, True, None) for i, old in held.items()]
    return out


_FOUND = "gram long, span long, least_offset int, most_offset int, doc long, row long, pos int, several boolean, passage long"
_FOUND_ARROW = pa.schema(
    [("gram", pa.int64()), ("span", pa.int64()), ("least_offset", pa.int32()), ("most_offset", pa.int32())]
    + [("doc", pa.int64()), ("row", pa.int64()), ("pos", pa.int32()), ("several", pa.bool_()), ("passage", pa.int64())]
)


def _neighbours(contexts: DataFrame, p: Passage) -> DataFrame:
    """``compare`` over the sorted suffixes of each task, a block at a time; with the place of the first of the run."""

    def block(table: pa.Table) -> pa.RecordBatch:
        gram, span, after, before, doc, row, pos, several = (c.combine_chunks() for c in table.columns)
        doc, row, pos = (x.to_numpy() for x in (doc, row, pos))
        order = np.lexsort((pos, row, doc))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        several = several.to_numpy(zero_copy_only=False)
        rows = compare(gram.to_numpy(), after.to_pylist(), before.to_pylist(), place, several, p)
        at, least, most, first, again, key = zip(*rows) if rows else [()] * 6
        first = order[np.array(first, np.int64)]
        at = pa.array(at, pa.int64())
        columns = [gram.take(at), span.take(at), pa.array(least, pa.int32()), pa.array(most, pa.int32())]
        columns += [pa.array(doc[first], pa.int64()), pa.array(row[first], pa.int64()), pa.array(pos[first].astype(np.int32))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(again, pa.bool_()), pa.array(key, pa.int64())], schema=_FOUND_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for whole in batches:
            for batch in (whole.slice(k, _BLOCK) for k in range(0, whole.num_rows, _BLOCK)):
                waiting.append(batch)
                if sum(b.num_rows for b in waiting) >= _BLOCK:
                    yield block(pa.Table.from_batches(waiting))
                    waiting = []
        if waiting:
            yield block(pa.Table.from_batches(waiting))

    keys = ["gram", "after", "before"]
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return contexts.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(thrifty(run), _FOUND)


def _repeats(texts: DataFrame, p: Passage) -> DataFrame:
    """``doc, row, start_word, end_word, duplicate`` of ``texts`` (``doc, row, text``); see ``repeats``."""
    marks = stored(_marks(texts, p), "minimisers")
    place = F.struct("doc", "row", "pos")
    classes = stored(
        marks.groupBy("gram", "span")
        .agg(*(F.min(c).alias(c) for c in ("before", "after", "left", "right")), F.min(place).alias("least"), F.max(place).alias("most"))
        .withColumn("several", F.expr("least < most"))
        .drop("most"),
        "classes",
    )
    sides = classes.select("gram", "span", F.explode(F.array("before", "after")).alias("side")).where("side IS NOT NULL")
    shared = sides.groupBy("side").agg(F.min(F.struct("gram", "span")).alias("a"), F.max(F.struct("gram", "span")).alias("b"))
    shared = stored(shared.where("a < b").select("side"), "sides")
    to_sort = stored(sides.join(shared, "side", "left_semi").select("gram", "span").distinct(), "compared")
    compared = classes.join(to_sort, ["gram", "span"], "left_semi")
    alone = classes.where("several").join(to_sort, ["gram", "span"], "left_anti")
    contexts = stored(_contexts(texts, compared, p), "suffixes")
    found = stored(_neighbours(contexts, p), "neighbours")
    first = F.struct("doc", "row", "pos")
    unsettled = found.where("passage IS NOT NULL")
    joined = unsettled.groupBy("gram", "passage").agg(
        F.min(first).alias("least"),
        (F.max("several") | (F.min(F.struct("doc", "row", "pos")) < F.max(first))).alias("again"),
    )
    joined = stored(joined.where("again").drop("again"), "rejoined")
    offsets = ["gram", "span", "least_offset", "most_offset", "least"]
    ranges = (
        found.where("passage IS NULL").withColumn("least", first).select(offsets)
        .union(unsettled.join(joined, ["gram", "passage"]).select(offsets))
        .union(alone.select("gram", "span", F.col("right").alias("least_offset"), F.col("left").alias("most_offset"), "least"))
    )
    of_class = stored(
        ranges.groupBy("gram", "span").agg(F.collect_list(F.struct("least_offset", "most_offset", "least")).alias("ranges")), "ranges"
    )
    hits = marks.select("gram", "span", "doc", "row", "pos").join(of_class, ["gram", "span"])
    hits = hits.select("doc", "row", "pos", F.inline("ranges")).withColumn("later", place > F.col("least"))
    spans = hits.select(
        "doc", "row",
        (F.col("pos") - F.col("most_offset")).cast("long").alias("first"),
        (F.col("pos") - F.col("least_offset") + p.min_words).cast("long").alias("last"),
        F.explode(F.when(F.col("later"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("duplicate"),
    )
    ends = Window.partitionBy("doc", "row", "duplicate").orderBy("first", "last")
    reach = F.max("last").over(ends.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("new", F.coalesce((F.col("first") > reach).cast("int"), F.lit(1))).withColumn(
        "island", F.sum("new").over(ends.rowsBetween(Window.unboundedPreceding, 0))
    )
    return islands.groupBy("doc", "row", "duplicate", "island").agg(
        F.min("first").alias("start_word"), F.max("last").alias("end_word")
    ).select("doc", "row", "start_word", "end_word", "duplicate")


#: In place of a null id, so that such rows come after all others.
_NO_ID = (1 << 63) - 1


def _row(docs: DataFrame) -> tuple[Column, Column]:
    """The key of a row: its id, and a hash of its text with the last bit set where the id is null."""
    doc_id = docs["doc_id"].cast("long")
    return F.coalesce(doc_id, F.lit(_NO_ID)), F.shiftleft(F.xxhash64(docs["text"]), 1).bitwiseOR(doc_id.isNull().cast("long"))


def _keyed(docs: DataFrame) -> DataFrame:
    doc, row = _row(docs)
    return docs.select(doc.alias("doc"), row.alias("row"), "text")


def repeats(docs: DataFrame, passage: Passage | None = None) -> DataFrame:
    """Repeated passages: ``doc_id, start_word, end_word, n_words, duplicate``; words are counted from 0, the end is exclusive.

    With ``duplicate`` false: each longest stretch of a document that is covered by passages of at least ``min_words`` words which
    occur elsewhere, in this or another document; every occurrence has its row. With ``duplicate`` true: the parts of these
    that also stand at a lower ``(doc_id, position)`` and can be cut without losing a text.

    Documents without a repeated passage, null, empty and short ones have no row. Very long texts are read whole, each by one task. Rows
    with a null id are compared like all others and come last in the order. Different texts under one id are documents of their own, in the
    order of a hash; rows that repeat id and text count as one. Other columns are ignored.
    """
    n_words = F.col("end_word") - F.col("start_word")
    doc_id = F.when(F.col("row").bitwiseAND(F.lit(1)) == 0, F.col("doc"))
    found = _repeats(_keyed(docs), passage or Passage())
    return found.select(doc_id.alias("doc_id"), "start_word", "end_word", n_words.alias("n_words"), "duplicate")


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the given spans of words, each with the white space after it."""
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for first, last in sorted(spans):
        first, last = max(first, 0), min(last, len(starts) - 1)
        out.append(text[at : max(at, starts[first])])
        at = max(at, starts[last])
    return "".join([*out, text[at:]])


def without_duplicates(docs: DataFrame, passage: Passage | None = None) -> DataFrame:
    """``docs`` with the duplicate parts of repeated passages cut from ``text``, and ``n_chars``, if there, counted anew.

    Documents of which no word is left go; all others stay, those without a duplicate unchanged. Rows are told apart as in
    ``repeats``, those without an id too. An empty table gives an empty one.
    """
    spans = _repeats(_keyed(docs), passage or Passage()).where("duplicate")
    name, key, row_key = (free_name(docs, n) for n in ("spans", "span_id", "span_row"))
    per_doc = stored(
        spans.groupBy(F.col("doc").alias(key), F.col("row").alias(row_key)).agg(
            F.collect_list(F.struct("start_word", "end_word")).alias(name)
        ),
        "cuts",
    )
    # Most texts without a cut are passed over by a table of bits and stay where they are; the others meet their cuts in one join.
    shared = docs.sparkSession.sparkContext.broadcast(taken_slots(per_doc.select(slot(key, row_key).alias("slot"))))

    @F.pandas_udf("boolean")
    def taken(slots: pd.Series) -> pd.Series:
        return pd.Series(is_taken(shared.value, slots.to_numpy()))

    doc, row = _row(docs)
    whole, part = docs.where(~taken(slot(doc, row))), docs.where(taken(slot(doc, row)))
    doc, row = _row(part)
    joined = part.join(per_doc, (doc == per_doc[key]) & (row == per_doc[row_key]), "left").select(*docs.columns, name)
    columns, texts = docs.columns, joined.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = batch.column(batch.num_columns - 1).is_valid()
            yield batch.filter(pc.invert(has)).select(columns)
            batch = batch.filter(has)
            found = zip(batch.column(texts).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())
            cut = [cut_text(text, [(c["start_word"], c["end_word"]) for c in cuts]) for text, cuts in found]
            out = [pa.array(cut, batch.column(texts).type) if i == texts else c for i, c in enumerate(batch.columns[:-1])]
            keep = pa.array([bool(_WORD.search(text)) for text in cut], pa.bool_())
            yield pa.RecordBatch.from_arrays(out, names=columns).filter(keep)

    out = whole.union(joined.mapInArrow(thrifty(run), docs.schema))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
