"""Language by segmentation-marginalised unigrams.

A word can be cut into pieces of a fixed public vocabulary in many ways. Each language has a probability for each
piece; the probability of a word is the sum over all ways to cut it of the products of the pieces' probabilities, which a forward
pass over the bytes gives. The piece probabilities are fitted by expectation-maximisation, with expected counts from
forward and backward passes, on word counts of a sample of labelled documents that is bounded for each language. A text is scored by all its words.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import process_cache, stored, thrifty

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
UNKNOWN = "und"
#: Bytes that are no ASCII letter become spaces; those beyond ASCII stay.
_CLEAN = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: Distinct words whose scores a worker remembers before it starts anew, and their bytes in all.
CACHE_WORDS = 400_000
CACHE_BYTES = 1 << 25
#: Characters that are scored at once.
BLOCK = 1 << 20


#: Multiplier of the rolling hash that finds pieces of more than eight bytes.
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Fit:
    """How the model is fitted: documents of the sample (expected number, the same for each language, ``least`` or more), passes, pseudo-count of a piece."""

    sample: int = 20_000
    least: int = 200
    passes: int = 3
    pseudo: float = 0.05
    vocabulary: str = VOCABULARY


class Pieces:
    """The vocabulary: ids of all pieces, found by length and content."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            known = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
        self.names = sorted(known | {bytes([b]) for b in range(256)})
        self.size = len(self.names)
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(self.names):
            by_length.setdefault(len(piece), []).append(i)
        self.tables = []
        for n, ids in sorted(by_length.items()):
            text = np.frombuffer(b"".join(self.names[i] for i in ids), np.uint8).reshape(-1, n)
            keys = self._keys(text, n)[:, 0]
            order = np.argsort(keys)
            self.tables.append((n, keys[order], np.array(ids, np.int32)[order]))

    @staticmethod
    def _prefixes(text: np.ndarray) -> np.ndarray:
        """Rolling hashes of all prefixes of each row."""
        powers = np.cumprod(np.full(text.shape[1] + 1, _BASE))
        out = np.zeros((text.shape[0], text.shape[1] + 1), np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[:-1], axis=1, out=out[:, 1:])
        return out

    def _keys(self, text: np.ndarray, n: int, prefixes: np.ndarray | None = None) -> np.ndarray:
        """A key for the ``n`` bytes from each position: the bytes themselves up to eight, a hash beyond."""
        if n <= 8:
            keys = np.zeros((text.shape[0], text.shape[1] - n + 1), np.uint64)
            for k in range(n):
                keys = keys << np.uint64(8) | text[:, k : text.shape[1] - n + 1 + k]
            return keys
        prefixes = self._prefixes(text) if prefixes is None else prefixes
        # The later a stretch begins, the more powers its difference carries: all are brought to those of the end.
        rest = np.cumprod(np.full(text.shape[1] + 1, _INVERSE))[: text.shape[1] - n + 1]
        return (prefixes[:, n:] - prefixes[:, :-n]) * rest

    def lookup(self, words: list[bytes]) -> tuple[dict[int, np.ndarray], np.ndarray]:
        """For each length that occurs, ``ids[word, end]`` of the piece that ends there, or ``size``; and the lengths of the words."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths.max())
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        inside = np.arange(1, width + 1)[None, :] <= lengths[:, None]
        prefixes = self._prefixes(text) if width > 8 else None
        found = {}
        for n, keys, ids in self.tables:
            if n > width:
                break
            mine = self._keys(text, n, prefixes)
            at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            hit = (keys[at] == mine) & inside[:, n - 1 :]
            if n > 8:
                for row, start in np.argwhere(hit).tolist():
                    hit[row, start] = words[row][start : start + n] == self.names[ids[at[row, start]]]
            if hit.any():
                found[n] = np.full((len(words), width + 1), self.size, np.int32)
                found[n][:, n:][hit] = ids[at[hit]]
        return found, lengths


#: The inverse of ``_BASE`` modulo 2**64.
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@lru_cache(maxsize=2)
def pieces(vocabulary: str) -> Pieces:
    return Pieces(public_tokenizers.path(vocabulary))


def _by_length(words: list[bytes], most: int = 20_000) -> Iterator[np.ndarray]:
    """Indices of the words in groups of similar length and bounded size in all."""
    order = np.argsort([len(w) for w in words], kind="stable")
    start = 0
    while start < len(order):
        end = min(len(order), start + most)
        while end > start + 1 and (end - start) * len(words[order[end - 1]]) > 16 * most:
            end = start + (end - start) // 2
        yield order[start:end]
        start = end


def forward(found: dict[int, np.ndarray], lengths: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over all segmentations, ``[word, language]``. ``probs[piece, language]`` ends with a row of zeros.

    Each position is scaled by language, so that no word is too long.
    """
    n, width, longest = len(lengths), int(lengths.max()) + 1, max(found)
    # Sums up to each of the last positions, relative to the newest one, in a ring.
    alpha = np.zeros((longest + 1, n, probs.shape[1]))
    alpha[0] = 1.0
    scale, out = np.zeros((n, probs.shape[1])), np.zeros((n, probs.shape[1]))
    for i in range(1, width):
        now = np.zeros_like(scale)
        for k, ids in found.items():
            if k <= i:
                now += alpha[(i - k) % (longest + 1)] * probs[ids[:, i]]
        peak = np.where(now > 0, now, 1.0)
        alpha /= peak
        if longest > 24:
            # Far back, sums may be beyond a double's range relative to the newest one.
            np.minimum(alpha, 1e280, out=alpha)
        alpha[i % (longest + 1)] = now / peak
        scale += np.log(peak)
        ends = lengths == i
        out[ends] = scale[ends]
    return out


def expected_counts(
    found: dict[int, np.ndarray], lengths: np.ndarray, weights: np.ndarray, langs: np.ndarray, probs: np.ndarray, size: int
) -> np.ndarray:
    """Expected counts ``[piece, language]`` of the pieces in words of the given languages, each ``weights`` times.

    Sums up to a position, and from it on, are kept as logarithms, so that no word is too long.
    """
    n, width = len(lengths), int(lengths.max()) + 1
    with np.errstate(divide="ignore"):
        own = {k: np.log(probs[ids, langs[:, None]]) for k, ids in found.items()}  # [word, end]
    alpha, beta = np.full((n, width), -np.inf), np.full((n, width), -np.inf)
    alpha[:, 0] = 0.0
    for i in range(1, width):
        alpha[:, i] = np.logaddexp.reduce([alpha[:, i - k] + p[:, i] for k, p in own.items() if k <= i])
    rows = np.arange(n)
    for i in range(width - 1, -1, -1):
        steps = [own[k][:, i + k] + beta[:, i + k] for k in own if i + k < width]
        if steps:
            beta[:, i] = np.logaddexp.reduce(steps)
        beta[lengths == i, i] = 0.0
    counts = np.zeros((size + 1, probs.shape[1]))
    total = alpha[rows, lengths]
    for k, p in own.items():
        mass = np.exp(alpha[:, : width - k] + p[:, k:] + beta[:, k:] - total[:, None]) * weights[:, None]
        at = np.nonzero(mass)
        np.add.at(counts, (found[k][:, k:][at], langs[at[0]]), mass[at])
    return counts[:size]


def clean_words(text: str) -> list[bytes]:
    """The words of a text for scoring: lower case, only letters and what is not ASCII, each with a space before it."""
    return [b" " + w for w in text.lower().encode().translate(_CLEAN).split()]


@dataclass(frozen=True)
class Model:
    """Languages, their shares of the training documents, and ``probs[piece, language]`` with a last row of zeros."""

    langs: list[str]
    prior: np.ndarray
    probs: np.ndarray
    fit: Fit


def fit_model(labelled: DataFrame, fit: Fit | None = None) -> Model | None:
    """Fits the model to ``doc_id, text, lang``; None if there is nothing to learn from.

    Word counts of the sample stay distributed; for each pass, one number per piece and language comes to the driver.
    """
    fit = fit or Fit()
    shares = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return None
    langs, total = sorted(shares), sum(shares.values())
    million = 1_000_000
    quota = max(fit.least, -(-fit.sample // len(langs)))
    limits = F.create_map(*(F.lit(x) for lang, n in shares.items() for x in (lang, min(million, -(-quota * million // n)))))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(million)) < limits[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                seen.setdefault(lang, Counter()).update(clean_words(text))
            rows = [(lang, w, n) for lang, words in seen.items() for w, n in words.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), _COUNT.types)] if rows else [pa.array([], t) for t in _COUNT.types],
                schema=_COUNT,
            )

    words = stored(
        sample.select(F.coalesce("text", F.lit("")).alias("text"), "lang")
        .mapInArrow(thrifty(count), "lang string, word binary, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n")),
        "language_words",
    )
    size = pieces(fit.vocabulary).size
    number = {lang: i for i, lang in enumerate(langs)}
    probs = None
    for _ in range(fit.passes):
        known = probs

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = pieces(fit.vocabulary)
            use = np.vstack([np.full((size, len(langs)), 1.0 / size), np.zeros((1, len(langs)))]) if known is None else known
            counts = np.zeros((size, len(langs)))
            for batch in batches:
                own = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
                text, n = batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float)
                for at in _by_length(text):
                    found, lengths = vocabulary.lookup([text[i] for i in at])
                    counts += expected_counts(found, lengths, n[at], own[at], use, size)
            piece, lang = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(lang), pa.array(counts[piece, lang])], names=["piece", "lang", "n"]
            )

        sums = words.mapInArrow(thrifty(expect), "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full((size, len(langs)), fit.pseudo)
        counts[sums["piece"].to_numpy(np.int64), sums["lang"].to_numpy(np.int64)] += sums["n"].to_numpy(float)
        probs = np.vstack([counts / counts.sum(axis=0), np.zeros((1, len(langs)))])
    prior = np.array([shares[lang] / total for lang in langs])
    return Model(langs, prior, probs, fit)


_COUNT = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])


class Scorer:
    """Scores texts by a model, and remembers the words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.pieces = pieces(model.fit.vocabulary)
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.scores = np.zeros((0, len(model.langs)))

    def _learn(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), len(self.model.langs)))
        for at in _by_length(words):
            found, lengths = self.pieces.lookup([words[i] for i in at])
            out[at] = forward(found, lengths, self.model.probs)
        return out

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        words = [clean_words(t) if t else [] for t in texts]
        new = list({w for doc in words for w in doc if w not in self.known})
        self.held += sum(map(len, new))
        if len(self.known) + len(new) > CACHE_WORDS or self.held > CACHE_BYTES:
            self.known, self.scores, self.held = {}, self.scores[:0], 0
            new = list({w for doc in words for w in doc})
        for i, w in enumerate(new, len(self.known)):
            self.known[w] = i
        self.scores = np.vstack([self.scores, self._learn(new)]) if new else self.scores
        get, names, values = self.known.__getitem__, [], []
        for text, doc in zip(texts, words):
            if not text or not any(map(str.isalpha, text)):
                names.append(UNKNOWN)
                values.append(0.0)
                continue
            logs = np.log(self.model.prior) + self.scores[list(map(get, doc))].sum(axis=0)
            odds = np.exp(logs - logs.max())
            best = int(odds.argmax())
            names.append(self.model.langs[best])
            values.append(float(odds[best] / odds.sum()))
        return names, values


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score``; ``score`` is the posterior probability of the language.

    A text that is null or has no letter (``str.isalpha``) is ``und`` with score 0, and so is each if there is no model. Ties go to the first
    language in order of name. Words and texts of any length are scored whole; text without white space is one word. Rows that repeat are scored each; other columns are ignored.
    """
    if model is None:
        return docs.select(F.col("doc_id").cast("long"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_cache("languages", dict)
        scorer = Scorer(model)
        for batch in batches:
            texts, names, values, start, size = batch.column(1).to_pylist(), [], [], 0, 0
            for end, text in enumerate(texts, 1):
                size += len(text or "")
                if size >= BLOCK or end == len(texts):
                    n, v = scorer(texts[start:end])
                    names += n
                    values += v
                    start, size = end, 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(values, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(thrifty(run), "doc_id long, lang_pred string, score double")


def training_rows(docs: DataFrame, held_out: Column) -> DataFrame:
    """Labelled documents that may be learned from."""
    return docs.where(F.col("lang").isNotNull() & ~held_out).select("doc_id", "text", "lang")
