"""Toxicity by a bidirectional gated recurrent network with attention pooling.

The input of a word is the sum of an embedding of the word and the mean of embeddings of its character trigrams. A
gated recurrent network reads a window of words in both directions, attention pools its states, and a logistic unit scores the
pool. A document is scored by all its overlapping windows: the greatest window logit, calibrated together with
the number of windows. The network is trained in numpy on a bounded sample of labelled documents, of which only
the label of the whole is known: after each round the best-scoring window stands for a document.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import process_cache, stored

#: Distinct words whose input a worker remembers before it starts anew, and their bytes in all.
CACHE_WORDS = 200_000
CACHE_BYTES = 1 << 24
#: Words of documents that are scored at once.
BLOCK_WORDS = 1 << 17
#: Windows whose states are held at once: few enough for a processor's cache.
BLOCK_WINDOWS = 2048
#: Threads that score the sample on the driver.
THREADS = min(4, os.cpu_count() or 1)


@dataclass(frozen=True)
class Net:
    """Sizes and training. ``sample``: expected labelled documents of each class that are fitted."""

    window: int = 6
    word_rows: int = 1 << 15
    char_rows: int = 1 << 13
    inputs: int = 12
    hidden: int = 4
    attention: int = 4
    sample: int = 1500
    #: Rounds of training, after each of which the best windows are chosen anew, and the least steps of them all; a small
    #: sample is gone through several times in a round, up to ``most_passes``.
    epochs: int = 8
    steps: int = 600
    most_passes: int = 5
    rate: float = 0.01
    batch: int = 128
    threshold: float = 0.3


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def features(words: list[bytes], net: Net) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word its row of the word table; and flat rows of its character trigrams, with the word that each belongs to."""
    rows = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(net.word_rows)
    data = np.frombuffer(b"".join([b"^%b$" % w for w in words]), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(owner)) + 2 * owner  # each word has as many trigrams as bytes
    grams = (data[at] << np.uint64(16) | data[at + 1] << np.uint64(8) | data[at + 2]) * np.uint64(0x9E3779B97F4A7C15)
    return rows.astype(np.int64), (grams >> np.uint64(40)).astype(np.int64) % net.char_rows, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def starts(n: int, net: Net) -> np.ndarray:
    """First words of the windows of a text of ``n`` words: all that begin a whole window, or the first word."""
    return np.arange(max(1, n - net.window + 1))


@dataclass
class Weights:
    """The parameters, by name, and the calibration of documents."""

    net: Net
    p: dict[str, np.ndarray] = field(default_factory=dict)
    calibration: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0]))

    @classmethod
    def new(cls, net: Net, seed: int = 5) -> Weights:
        rng = np.random.default_rng(seed)
        e, h, a = net.inputs, net.hidden, net.attention
        shapes = {"word": (net.word_rows, e), "char": (net.char_rows, e), "attend": (2 * h, a), "attend_v": (a,), "out": (2 * h,)}
        for d in "fb":
            shapes |= {f"in_{d}": (e, 3 * h), f"rec_{d}": (h, 3 * h), f"bias_{d}": (3 * h,)}
        scale = {"word": 0.05, "char": 0.05, "bias_f": 0.0, "bias_b": 0.0}
        p = {k: (rng.standard_normal(s) * scale.get(k, 0.3)).astype(np.float32) for k, s in shapes.items()}
        return cls(net, p | {"bias": np.zeros(1, np.float32)})

    def inputs(self, rows: np.ndarray, grams: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The input of each word."""
        if not len(rows):
            return np.zeros((0, self.net.inputs), np.float32)
        count = np.bincount(owner, minlength=len(rows))
        chars = np.add.reduceat(self.p["char"][grams], np.cumsum(count) - count)
        return self.p["word"][rows] + chars / count[:, None].astype(np.float32)

    def run(self, projected: dict[str, np.ndarray], mask: np.ndarray | None, keep: bool = False) -> tuple:
        """Logits of windows from their projected inputs ``[window, place, 3 * hidden]`` by direction.

        ``mask``: 1 where there is a word; None if everywhere. ``keep``: also what the gradient needs.
        """
        h_size = self.net.hidden
        n, length, _ = projected["f"].shape
        states = np.zeros((n, length, 2 * h_size), np.float32)
        kept: dict[str, list] = {"f": [], "b": []}
        for d, order in (("f", range(length)), ("b", range(length - 1, -1, -1))):
            h, recur = np.zeros((n, h_size), np.float32), self.p[f"rec_{d}"]
            column = slice(0, h_size) if d == "f" else slice(h_size, None)
            for t in order:
                x, u = projected[d][:, t], h @ recur
                gates = 0.5 + 0.5 * np.tanh(0.5 * (x[:, : 2 * h_size] + u[:, : 2 * h_size]))
                z, r = gates[:, :h_size], gates[:, h_size:]
                new = np.tanh(x[:, 2 * h_size :] + r * u[:, 2 * h_size :])
                after = new + z * (h - new)
                if mask is not None:
                    after = np.where(mask[:, t, None] > 0, after, h)
                if keep:
                    kept[d].append((t, h, z, r, new, u[:, 2 * h_size :]))
                h = after
                states[:, t, column] = h
        hidden = np.tanh(states @ self.p["attend"])
        energy = hidden @ self.p["attend_v"]
        if mask is not None:
            energy = np.where(mask > 0, energy, -1e9)
        weight = np.exp(energy - energy.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pool = (weight[:, :, None] * states).sum(axis=1)
        logits = pool @ self.p["out"] + self.p["bias"][0]
        return (logits, (states, hidden, weight, pool, kept)) if keep else (logits,)

    def slide(self, tables: dict[str, np.ndarray]) -> np.ndarray:
        """The logits of ``run`` for the windows from each of consecutive words, by ``tables[direction][4 * hidden, word]`` of ``halved``.

        Windows lie one word apart, so the words at one place of all windows are a slice: nothing is copied for a window.
        """
        h_size, length = self.net.hidden, self.net.window
        n = tables["f"].shape[1] - length + 1
        states = np.empty((length, 2 * h_size, n), np.float32)
        for d, order in (("f", range(length)), ("b", range(length - 1, -1, -1))):
            recur, x = 0.5 * self.p[f"rec_{d}"].T, tables[d]
            rows = slice(0, h_size) if d == "f" else slice(h_size, None)
            h = x[3 * h_size :, order[0] : order[0] + n].copy()
            states[order[0], rows] = h
            for t in order[1:]:
                u = recur @ h
                # A gate is (1 + tanh(x / 2)) / 2; the halves are in the tables and in ``recur``.
                gates = u[: 2 * h_size]
                gates += x[: 2 * h_size, t : t + n]
                np.tanh(gates, out=gates)
                gates += 1.0
                new = u[2 * h_size :]
                new *= gates[h_size:]
                new += x[2 * h_size : 3 * h_size, t : t + n]
                np.tanh(new, out=new)
                h -= new
                h *= gates[:h_size]
                h *= 0.5
                h += new
                states[t, rows] = h
        energy = self.p["attend_v"] @ np.tanh(self.p["attend"].T @ states)
        weight = np.exp(energy - energy.max(axis=0))
        # The pool is a weighted mean of states, so its product with ``out`` is the mean of theirs.
        return (weight * (self.p["out"] @ states)).sum(axis=0) / weight.sum(axis=0) + self.p["bias"][0]

    def halved(self, projected: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Projected inputs as ``slide`` needs them: halved for gates, and with the state after a first word."""
        h_size, out = self.net.hidden, {}
        for d, x in projected.items():
            gates, new = 0.5 * x[:, : 2 * h_size], x[:, 2 * h_size :]
            first = 0.5 * (1.0 - np.tanh(gates[:, :h_size])) * np.tanh(new)
            out[d] = np.hstack([gates, new, first]).astype(np.float32)
        return out

    def projected(self, tables: dict[str, np.ndarray], ids: np.ndarray) -> dict[str, np.ndarray]:
        """The projected inputs of the words ``ids`` from ``halved`` ones."""
        h_size = self.net.hidden
        twice = np.repeat(np.array([2.0, 1.0], np.float32), [2 * h_size, h_size])
        return {d: x[ids][..., : 3 * h_size] * twice for d, x in tables.items()}

    def from_each_word(self, tables: dict[str, np.ndarray], ids: np.ndarray, threads: int = 1) -> np.ndarray:
        """The logits of the windows from each of the words ``ids``, rows of ``tables``, as far as whole windows go."""
        n, more = len(ids) - self.net.window + 1, self.net.window - 1

        def block(first: int) -> np.ndarray:
            part = ids[first : min(first + BLOCK_WINDOWS, n) + more]
            return self.slide({d: np.ascontiguousarray(tables[d].take(part, axis=0).T) for d in "fb"})

        firsts = range(0, n, BLOCK_WINDOWS)
        if threads == 1:
            found = [block(k) for k in firsts]
        else:
            with ThreadPoolExecutor(threads) as pool:
                found = list(pool.map(block, firsts))
        return np.concatenate(found) if found else np.zeros(0, np.float32)

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {d: x @ self.p[f"in_{d}"] + self.p[f"bias_{d}"] for d in "fb"}

    def gradient(self, x: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Loss, gradients of all but the tables, and the gradient of the inputs ``x[window, place, inputs]``."""
        h_size, p = self.net.hidden, self.p
        logits, (states, hidden, weight, pool, kept) = self.run(self.project(x), mask, keep=True)
        probability = _sigmoid(logits)
        loss = -np.mean(target * np.log(probability + 1e-7) + (1 - target) * np.log(1 - probability + 1e-7))
        g: dict[str, np.ndarray] = {}
        d_logit = ((probability - target) / len(target)).astype(np.float32)
        g["bias"], g["out"] = d_logit.sum(keepdims=True), d_logit @ pool
        d_pool = d_logit[:, None] * p["out"]
        d_weight = (d_pool[:, None, :] * states).sum(axis=2)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        g["attend_v"] = np.einsum("nt,nta->a", d_energy, hidden)
        d_hidden = d_energy[:, :, None] * p["attend_v"] * (1 - hidden * hidden)
        g["attend"] = np.einsum("nts,nta->sa", states, d_hidden)
        d_states = weight[:, :, None] * d_pool[:, None, :] + d_hidden @ p["attend"].T
        d_x = np.zeros_like(x)
        for d in "fb":
            column = slice(0, h_size) if d == "f" else slice(h_size, None)
            recur, d_h = p[f"rec_{d}"], np.zeros((len(x), h_size), np.float32)
            g_in, g_rec, g_bias = (np.zeros_like(p[f"{k}_{d}"]) for k in ("in", "rec", "bias"))
            for t, h, z, r, new, u_new in reversed(kept[d]):
                d_h = d_h + d_states[:, t, column]
                live = mask[:, t, None]
                d_new = d_h * (1 - z) * live * (1 - new * new)
                d_z = d_h * (h - new) * live * z * (1 - z)
                d_r = d_new * u_new * r * (1 - r)
                d_gate = np.concatenate([d_z, d_r, d_new], axis=1)
                d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g_in += x[:, t].T @ d_gate
                g_bias += d_gate.sum(axis=0)
                g_rec += h.T @ d_u
                d_x[:, t] += d_gate @ p[f"in_{d}"].T
                d_h = d_h * np.where(live > 0, z, 1.0) + d_u @ recur.T
            g |= {f"in_{d}": g_in, f"rec_{d}": g_rec, f"bias_{d}": g_bias}
        return float(loss), g, d_x


def _windows(texts: list[np.ndarray], net: Net) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word numbers of all texts in a row, short ones filled up by -1; where each window begins there; and the windows of each text."""
    at = [starts(len(ids), net) for ids in texts]
    padded = [np.append(ids, np.full(max(0, net.window - len(ids)), -1, np.int64)) for ids in texts]
    ends = np.cumsum([len(p) for p in padded])
    begin = np.concatenate([a + end - len(p) for a, p, end in zip(at, padded, ends)])
    return np.concatenate(padded), begin, np.array([len(a) for a in at])


class _Sample:
    """Labelled texts, and all their windows, over one list of distinct words. A window is made when it is read."""

    def __init__(self, texts: list[list[bytes]], net: Net) -> None:
        self.net = net
        number: dict[bytes, int] = {}
        self.texts = [np.array([number.setdefault(w, len(number)) for w in words], np.int64) for words in texts]
        self.flat, self.at, self.counts = _windows(self.texts, net)
        self.words = list(number)
        self.features = features(self.words, net)
        self.owner = np.repeat(np.arange(len(texts)), self.counts)

    def windows(self, which: np.ndarray | slice) -> np.ndarray:
        return self.flat[self.at[which][:, None] + np.arange(self.net.window)]

    def sums(self, value: np.ndarray) -> np.ndarray:
        """The sum over each window of a value of each distinct word; the last value is that of no word."""
        total = np.append(0.0, np.cumsum(value[self.flat]))
        return total[self.at + self.net.window] - total[self.at]

    def logits(self, weights: Weights) -> np.ndarray:
        x = np.vstack([weights.inputs(*self.features), np.zeros((1, self.net.inputs), np.float32)])
        tables = weights.halved(weights.project(x))
        out = weights.from_each_word(tables, self.flat, THREADS)[self.at]
        # A text shorter than a window has one, with a gap.
        short = np.flatnonzero(self.flat[self.at + self.net.window - 1] < 0)
        for part in np.array_split(short, 1 + len(short) // 2048):
            ids = self.windows(part)
            out[part] = weights.run(weights.projected(tables, ids), (ids >= 0).astype(np.float32))[0]
        return out

    def best(self, logits: np.ndarray) -> np.ndarray:
        """The window of each text with the greatest logit."""
        order = np.lexsort((logits, self.owner))
        last = np.append(self.owner[order][1:] != self.owner[order][:-1], True)
        return order[last]


def train(texts: list[list[bytes]], toxic: np.ndarray, net: Net, seed: int = 5) -> Weights:
    """Fits the network to word lists and labels of 0 and 1, by Adam, and calibrates it on a quarter that it was not fitted to."""
    rng = np.random.default_rng(seed)
    weights = Weights.new(net, seed)
    data = _Sample(texts, net)
    fitted = rng.random(len(texts)) < 0.75
    # The first input of a word starts from how much more often toxic documents have it.
    rows, _, _ = data.features
    df = np.zeros((2, net.word_rows))
    for i, ids in enumerate(data.texts):
        if fitted[i]:
            df[int(toxic[i]), np.unique(rows[ids])] += 1
    size = np.array([max(1, (fitted & (toxic == k)).sum()) for k in (0, 1)])
    odds = np.log((df[1] + 0.3) / (size[1] + 0.6)) - np.log((df[0] + 0.3) / (size[0] + 0.6))
    weights.p["word"][:, 0] = np.where(df.sum(axis=0) > 2, np.clip(odds, -3, 3), 0.0)
    hint = np.append(weights.p["word"][rows, 0], 0.0)
    logits = data.sums(np.maximum(hint, 0.0))
    moment: dict[str, list[np.ndarray]] = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in weights.p.items()}
    step = 0
    per_epoch = max(1, 2 * int(fitted.sum()) // net.batch)
    passes = min(net.most_passes, max(1, -(-net.steps // (net.epochs * per_epoch))))

    def batches() -> Iterator[np.ndarray]:
        """The best windows of all fitted texts, and others of texts that are not toxic, by chance."""
        best = data.best(logits)
        for _ in range(passes):
            chance = rng.integers(0, len(data.at), len(best))
            chance = chance[(toxic[data.owner[chance]] == 0) & fitted[data.owner[chance]]]
            chosen = np.concatenate([best[fitted[data.owner[best]]], chance])
            yield from np.array_split(rng.permutation(chosen), max(1, len(chosen) // net.batch))

    for _ in range(net.epochs):
        for at in batches():
            step += 1
            ids = data.windows(at)
            mask = (ids >= 0).astype(np.float32)
            used, place = np.unique(ids[ids >= 0], return_inverse=True)
            rows, grams, owner = features([data.words[i] for i in used], net)
            x = np.zeros((*ids.shape, net.inputs), np.float32)
            x[ids >= 0] = weights.inputs(rows, grams, owner)[place]
            _, g, d_x = weights.gradient(x, mask, toxic[data.owner[at]].astype(np.float32))
            d_word = np.zeros((len(used), net.inputs), np.float32)
            np.add.at(d_word, place, d_x[ids >= 0])
            share = np.bincount(owner, minlength=len(used))[:, None].astype(np.float32)
            for table, at_rows, change in (("word", rows, d_word), ("char", grams, (d_word / share)[owner])):
                unique, inverse = np.unique(at_rows, return_inverse=True)
                total = np.zeros((len(unique), net.inputs), np.float32)
                np.add.at(total, inverse, change)
                _adam(weights.p[table], moment[table], total, net.rate, step, unique)
            for k, v in g.items():
                _adam(weights.p[k], moment[k], v, net.rate, step)
        logits = data.logits(weights)
    best = data.best(logits)
    apart = ~fitted if len(set(toxic[~fitted].tolist())) == 2 else np.ones(len(texts), bool)
    x = np.stack([logits[best], np.log(data.counts), np.ones(len(best))], axis=1)
    weights.calibration = _logistic(x[apart], toxic[apart].astype(float))
    return weights


def _adam(value: np.ndarray, moment: list[np.ndarray], g: np.ndarray, rate: float, step: int, rows=slice(None)) -> None:
    first, second = moment
    first[rows] = 0.9 * first[rows] + 0.1 * g
    second[rows] = 0.99 * second[rows] + 0.01 * g * g
    value[rows] -= rate * (first[rows] / (1 - 0.9**step)) / (np.sqrt(second[rows] / (1 - 0.99**step)) + 1e-6)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton's steps, for a few columns of which the last is constant."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + _solve(curve, x.T @ (y - p) - ridge * w)
    return w


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Elimination for a few unknowns."""
    work = np.hstack([a, b[:, None]])
    for i in range(len(work)):
        k = i + int(np.argmax(np.abs(work[i:, i])))
        work[[i, k]] = work[[k, i]]
        work[i] /= work[i, i]
        for j in range(len(work)):
            if j != i:
                work[j] -= work[j, i] * work[i]
    return work[:, -1]


def fit_model(docs: DataFrame, known: DataFrame, net: Net | None = None) -> Weights | None:
    """Fits the network to the texts of ``docs`` with the labels ``known`` (``doc_id, toxic``); None unless both labels occur.

    Of each label about ``net.sample`` documents come to the driver, chosen by a hash of the id; the bound does not grow with the
    data. The ids are chosen first, so that the texts of all others stay where they are. An id that stands in several rows is one document, with
    the greatest of its texts and labels.
    """
    net = net or Net()
    labelled = known.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    million = 1_000_000
    limit = {k: min(million, -(-net.sample * million // n)) for k, n in counts.items()}
    bound = F.when(F.col("toxic") == 1, limit[1]).otherwise(limit[0])
    chosen = stored(labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(million)) < bound), "toxicity_sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("toxic").alias("toxic")).collect()
    if len({r["toxic"] for r in rows}) < 2:
        return None
    rows.sort(key=lambda r: r["doc_id"])
    return train([words_of(r["text"]) for r in rows], np.array([r["toxic"] for r in rows]), net)


class Scorer:
    """Scores texts by the network, and remembers the projected inputs of words."""

    def __init__(self, weights: Weights) -> None:
        self.weights = weights
        self.clear()

    def clear(self) -> None:
        width = 4 * self.weights.net.hidden
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.inputs = {d: np.zeros((0, width), np.float32) for d in "fb"}

    def __call__(self, texts: list[list[bytes]]) -> np.ndarray:
        """The calibrated probability of each text, from all its windows."""
        net = self.weights.net
        new = list({w for words in texts for w in words if w not in self.known})
        self.held += sum(map(len, new))
        if len(self.known) + len(new) > CACHE_WORDS or self.held > CACHE_BYTES:
            self.clear()
            new = list({w for words in texts for w in words})
        for i, w in enumerate(new, len(self.known)):
            self.known[w] = i
        if new:
            fresh = self.weights.halved(self.weights.project(self.weights.inputs(*features(new, net))))
            self.inputs = {d: np.vstack([self.inputs[d], fresh[d]]) for d in "fb"}
        ids = [np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)) for words in texts]
        best, counts = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
        long = [k for k, i in enumerate(ids) if len(i) >= net.window]
        short = [k for k, i in enumerate(ids) if len(i) < net.window]
        if long:
            flat, at, counts[long] = _windows([ids[k] for k in long], net)
            logits = self.weights.from_each_word(self.inputs, flat)[at]
            best[long] = np.maximum.reduceat(logits, np.cumsum(counts[long]) - counts[long])
        for group in (short[k : k + 2048] for k in range(0, len(short), 2048)):
            flat, at, counts[group] = _windows([ids[k] for k in group], net)
            part = flat[at[:, None] + np.arange(net.window)]
            # A word that is not there reads the last row; the mask keeps it out.
            tables = {d: (x if len(x) else np.zeros((1, x.shape[1]), np.float32)) for d, x in self.inputs.items()}
            best[group] = self.weights.run(self.weights.projected(tables, part), (part >= 0).astype(np.float32))[0]
        return _sigmoid(np.stack([best, np.log(counts), np.ones(len(best))], axis=1) @ self.weights.calibration)


def toxicity(docs: DataFrame, weights: Weights | None, held_out: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, score, predicted`` (and ``held_out``, if given); ``predicted``: the score reaches the threshold.

    Texts that are null or have no word are scored by a window without words. With no model, the score is 0. Rows that repeat are
    scored each; null ids pass through; other columns are ignored.
    """
    net = weights.net if weights else Net()
    extra = [] if held_out is None else [held_out.alias("held_out")]
    if weights is None:
        return docs.select(F.col("doc_id").cast("long"), *extra, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_cache("toxicity", dict)
        scorer = Scorer(shared.value)
        for batch in batches:
            scores, held, size = [], [], 0
            for text in batch.column(1):
                held.append(words_of(text.as_py()))
                size += len(held[-1])
                if size >= BLOCK_WORDS:
                    scores.append(scorer(held))
                    held, size = [], 0
            if held:
                scores.append(scorer(held))
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(score), pa.array((score >= net.threshold).astype(np.int32))],
                names=["doc_id", *batch.schema.names[2:], "score", "predicted"],
            )

    held_type = "" if held_out is None else "held_out boolean, "
    return docs.select(F.col("doc_id").cast("long"), "text", *extra).mapInArrow(
        run, f"doc_id long, {held_type}score double, predicted int"
    )
