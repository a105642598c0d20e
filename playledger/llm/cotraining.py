"""Document quality by co-training.

Two classifiers see different things: one the content of the text (its bytes and words), the other the metadata of the page
(source, language, length and layout). Each is fitted to labelled documents; then, for some rounds, each labels the unlabelled documents it is
sure of for the other one. In the end both are calibrated on labelled documents that were not used, and a small logistic
model combines the calibrated views into one score for every document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import stored

_SPACE_BYTES = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)


@dataclass(frozen=True)
class Fit:
    """Sizes and training. ``sample``: expected documents of each kind (labelled, unlabelled) that the models are fitted to."""

    words: int = 256
    sources: int = 64
    sample: int = 6000
    rounds: int = 4
    #: A pseudo-label needs this probability; a round gives at most this share of the labelled documents to each view.
    sure: float = 0.95
    share: float = 0.25
    steps: int = 200
    rate: float = 0.05
    ridge: float = 1e-3
    #: Documents with this score are kept.
    threshold: float = 0.5


def text_view(text: str | None, fit: Fit) -> np.ndarray:
    """Content: share of each byte, of hashed words, and measures of words and repetition."""
    raw = (text or "").encode()
    words = raw.lower().split()
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    distinct = set(words)
    hashed = np.zeros(fit.words)
    for w in distinct:
        hashed[xxhash.xxh3_64_intdigest(w) % fit.words] += 1.0
    n = max(1, len(words))
    size = max(1, len(raw))
    spaces = int(histogram[_SPACE_BYTES].sum())
    upper, digits = int(histogram[65:91].sum()), int(histogram[48:58].sum())
    letters = int(histogram[97:123].sum()) + upper + int(histogram[128:].sum())
    more = [len(distinct) / n, (size - spaces) / n / 10, upper / size, digits / size, (size - spaces - letters - digits) / size, math.log1p(n)]
    return np.concatenate([np.sqrt(histogram / size), np.sqrt(hashed / n), more]).astype(np.float32)


def meta_view(text: str | None, lang: str | None, source: str | None, fit: Fit) -> np.ndarray:
    """Metadata: source and language hashed to indicators, length and layout."""
    text = text or ""
    lines = [line for line in text.split("\n") if line.strip()]
    n = max(1, len(lines))
    out = np.zeros(fit.sources + 16 + 8, np.float32)
    out[xxhash.xxh3_64_intdigest(source or "") % fit.sources] = 1.0
    out[fit.sources + xxhash.xxh3_64_intdigest(lang or "") % 16] = 1.0
    lengths = np.array([len(line) for line in lines] or [0])
    out[fit.sources + 16 :] = [
        math.log1p(len(text)),
        math.log1p(len(lines)),
        math.log1p(lengths.mean()),
        lengths.std() / (lengths.mean() + 1.0),
        len(set(lines)) / n,
        sum(line.rstrip()[-1] in ".!?" for line in lines) / n,
        math.log1p(lengths.max()),
        sum(line[0].isupper() for line in lines) / n,
    ]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


class Logistic:
    """Logistic regression on standardised columns, fitted by Adam with a ridge; labels may be weighted."""

    def __init__(self, x: np.ndarray, y: np.ndarray, fit: Fit) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = np.hstack([self.standard(x), np.ones((len(x), 1))])
        # Both labels count alike, which a later calibration corrects.
        weight = np.where(y > 0.5, 0.5 / max(1e-9, (y > 0.5).mean()), 0.5 / max(1e-9, (y <= 0.5).mean())) / len(y)
        self.w, first, second = np.zeros(z.shape[1]), 0.0, 0.0
        for t in range(1, fit.steps + 1):
            g = z.T @ (weight * (_sigmoid(z @ self.w) - y)) + fit.ridge * self.w
            first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
            self.w = self.w - fit.rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8.0, 8.0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.w[:-1] + self.w[-1]


@dataclass(frozen=True)
class Model:
    text: Logistic
    meta: Logistic
    #: Slope and constant for each view, then weights of the two calibrated logits and a constant.
    calibration: np.ndarray
    combination: np.ndarray
    fit: Fit

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities: combined, of the text view, of the metadata view."""
        a = self.calibration[0, 0] * self.text.logits(text) + self.calibration[0, 1]
        b = self.calibration[1, 0] * self.meta.logits(meta) + self.calibration[1, 1]
        return _sigmoid(a * self.combination[0] + b * self.combination[1] + self.combination[2]), _sigmoid(a), _sigmoid(b)


def _plain(x: np.ndarray, y: np.ndarray, steps: int = 2000) -> np.ndarray:
    """Logistic regression of a few columns, the last one constant, by gradient steps."""
    scale = x.std(axis=0)
    scale = np.where(scale > 0, scale, 1.0)
    z, w = x / scale, np.zeros(x.shape[1])
    for _ in range(steps):
        w -= 0.5 * (z.T @ (_sigmoid(z @ w) - y) / len(y) + 1e-4 * w)
    return w / scale


def cotrain(labelled: tuple[np.ndarray, np.ndarray, np.ndarray], pool: tuple[np.ndarray, np.ndarray], fit: Fit, seed: int = 9) -> Model:
    """Fits both views. ``labelled``: text view, metadata view, labels; ``pool``: the two views of unlabelled documents."""
    rng = np.random.default_rng(seed)
    apart = rng.random(len(labelled[2])) < 0.3
    if len(set(labelled[2][apart].tolist())) < 2 or len(set(labelled[2][~apart].tolist())) < 2:
        apart = np.zeros(len(labelled[2]), bool)
    y = labelled[2][~apart].astype(float)
    base = [v[~apart] for v in labelled[:2]]
    given: list[dict[int, float]] = [{}, {}]  # pseudo-labels that each view has received
    views: list[Logistic] = []
    for turn in range(fit.rounds + 1):
        views = []
        for k in (0, 1):
            at = np.array(sorted(given[k]), int)
            x = np.vstack([base[k], pool[k][at]]) if len(at) else base[k]
            views.append(Logistic(x, np.append(y, [given[k][i] for i in at]), fit))
        if turn == fit.rounds or not len(pool[0]):
            break
        for k in (0, 1):
            p = _sigmoid(views[k].logits(pool[k]))
            most = max(1, int(fit.share * len(y)))
            for label, sure in ((1.0, p), (0.0, 1.0 - p)):
                free = np.array([i for i in np.flatnonzero(sure >= fit.sure) if i not in given[1 - k]], int)
                part = most * (y.mean() if label else 1 - y.mean())
                for i in free[np.argsort(-sure[free], kind="stable")][: max(1, int(part))]:
                    given[1 - k][int(i)] = label
    check = apart if apart.any() else ~apart
    truth = labelled[2][check].astype(float)
    logits = [v.logits(x[check]) for v, x in zip(views, labelled[:2])]
    one = np.ones(len(truth))
    calibration = np.array([_plain(np.stack([z, one], axis=1), truth) for z in logits])
    both = [c[0] * z + c[1] for c, z in zip(calibration, logits)]
    return Model(views[0], views[1], calibration, _plain(np.stack([*both, one], axis=1), truth), fit)


_VIEWS = "quality int, text_view binary, meta_view binary"


def _views(docs: DataFrame, fit: Fit) -> DataFrame:
    """``quality, text_view, meta_view`` of ``text, lang, source, quality``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, metas = [], []
            for text, lang, source in zip(*(batch.column(i) for i in range(3))):
                text, lang, source = text.as_py(), lang.as_py(), source.as_py()
                texts.append(text_view(text, fit).tobytes())
                metas.append(meta_view(text, lang, source, fit).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), pa.array(texts, pa.binary()), pa.array(metas, pa.binary())], names=["quality", "text_view", "meta_view"]
            )

    return docs.select("text", F.col("lang").cast("string"), F.col("source").cast("string"), F.col("quality").cast("int")).mapInArrow(run, _VIEWS)


def fit_model(docs: DataFrame, known: DataFrame, fit: Fit | None = None) -> Model | None:
    """Fits to ``docs`` (``doc_id, text, lang, source``) and the labels ``known`` (``doc_id, quality``); None unless both labels
    occur. Documents without a label are the pool.

    The ids are chosen first, so that the texts of all other documents stay where they are. About ``fit.sample`` labelled and as many unlabelled documents are chosen by a hash of the id. Their features, of a fixed
    size, come to the driver, so the bound does not grow with the data.
    """
    fit = fit or Fit()
    kind = F.coalesce(F.col("quality"), F.lit(-1))
    ids = docs.select("doc_id").join(known.select("doc_id", "quality"), "doc_id", "left")
    counts = {r["kind"]: r["n"] for r in ids.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).collect()}
    with_label = counts.get(0, 0) + counts.get(1, 0)
    if not (counts.get(0) and counts.get(1)):
        return None
    million = 1_000_000
    limits = [min(million, -(-fit.sample * million // max(1, n))) for n in (with_label, counts.get(-1, 0))]
    bound = F.when(kind.isin(0, 1), limits[0]).when(kind == -1, limits[1]).otherwise(0)
    chosen = stored(ids.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(million)) < bound).distinct(), "quality_sample")
    texts = docs.select("doc_id", "text", "lang", "source").join(F.broadcast(chosen), "doc_id")
    rows = _views(texts, fit).toPandas()
    # Sorted, so that the fit does not depend on the order in which tasks end.
    rows = rows.sort_values(["text_view", "meta_view"], kind="stable").reset_index(drop=True)
    text, meta = (np.stack([np.frombuffer(x, np.float32) for x in rows[c]]) for c in ("text_view", "meta_view"))
    known = rows["quality"].notna().to_numpy()
    quality = rows["quality"].to_numpy(float)[known].astype(int)
    if len(set(quality.tolist())) < 2:
        return None
    return cotrain((text[known], meta[known], quality), (text[~known], meta[~known]), fit)


def quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: ``doc_id, score, text_score, meta_score, kept``; ``kept``: the score reaches the threshold.

    Null texts count as empty, null sources and languages as such. With no model each document has score 1 and is kept. Rows that
    repeat are scored each; null ids pass through; other columns are ignored.
    """
    if model is None:
        one = F.lit(1.0)
        return docs.select(F.col("doc_id").cast("long"), one.alias("score"), one.alias("text_score"), one.alias("meta_score"), F.lit(True).alias("kept"))
    fit = model.fit
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in batches:
            out: list[tuple] = []
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                rows = list(zip(*(c.to_pylist() for c in part.columns[1:])))
                text = np.stack([text_view(t, fit) for t, _, _ in rows])
                out.append(scorer.scores(text, np.stack([meta_view(t, g, s, fit) for t, g, s in rows])))
            scores = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(s, pa.float64()) for s in scores), pa.array(scores[0] >= fit.threshold)],
                names=["doc_id", "score", "text_score", "meta_score", "kept"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"), F.col("source").cast("string")).mapInArrow(
        run, "doc_id long, score double, text_score double, meta_score double, kept boolean"
    )
