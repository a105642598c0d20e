"""Learned operators: against brute force where there is one, else by accuracy on held-out rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from playledger.llm import context_tree, cotraining, langid, queries, toxicity
from playledger.llm.common import documents, fold, labels

SF_DIR = "/root/testdata/sf0.01"


def test_fold(spark):
    ids = spark.range(200).withColumnRenamed("id", "doc_id")
    found = {r.doc_id: r.f for r in ids.select("doc_id", fold(F.col("doc_id"), 7).alias("f")).collect()}
    assert found == {i: zlib.crc32(str(i).encode()) % 7 for i in range(200)}


# --- language -----------------------------------------------------------------------------------


def segmentations(word, longest):
    if not word:
        yield []
    for k in range(1, min(longest, len(word)) + 1):
        for rest in segmentations(word[k:], longest):
            yield [word[:k], *rest]


def test_forward_sums_all_segmentations_and_counts_match():
    pieces = langid.pieces(langid.VOCABULARY)
    rng = np.random.default_rng(1)
    probs = np.vstack([rng.random((pieces.size, 2)) / 50, np.zeros((1, 2))])
    words = [b" the", b" a", b"xqzjv", "été".encode(), b" information"]
    number = {name: i for i, name in enumerate(pieces.names)}
    assert pieces.size == len(number) >= 50_000 and b" information" in number
    found, lengths = pieces.lookup(words)
    logs = langid.forward(found, lengths, probs)
    langs, weights = np.array([0, 1, 0, 1, 0]), np.arange(1.0, 6.0)
    counts = langid.expected_counts(found, lengths, weights, langs, probs, pieces.size)
    wanted = np.zeros_like(counts)
    for w, word in enumerate(words):
        ways = [s for s in segmentations(word, 12) if all(p in number for p in s)]
        for lang in (0, 1):
            total = sum(math.prod(probs[number[p], lang] for p in s) for s in ways)
            assert math.isclose(math.exp(logs[w, lang]), total, rel_tol=1e-9)
        total = sum(math.prod(probs[number[p], langs[w]] for p in s) for s in ways)
        for s in ways:
            share = weights[w] * math.prod(probs[number[p], langs[w]] for p in s) / total
            for p in s:
                wanted[number[p], langs[w]] += share
    assert np.allclose(counts, wanted)


def test_languages_of_held_out_documents(spark):
    rows = queries.op1_langid(spark, SF_DIR).join(documents(spark, SF_DIR).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, edges, nothing):
    learn = spark.createDataFrame([(1, "the house and the dog", "en"), (2, "das Haus und der Hund", "de")], "doc_id long, text string, lang string")
    model = langid.fit_model(learn)
    rows = langid.identify(edges, model).collect()
    assert len(rows) == edges.count()
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 8)} == {"und"}
    assert all(r.lang_pred in ("en", "de") for r in rows if r.doc_id in (4, 5, 9))
    assert langid.identify(nothing, model).count() == 0
    assert langid.fit_model(learn.limit(0)) is None
    assert {r.lang_pred for r in langid.identify(edges, None).collect()} == {"und"}


def test_long_words_have_the_counts_of_their_parts():
    """A word of many bytes is neither lost nor out of range: its expected pieces cover each of its bytes once."""
    pieces = langid.pieces(langid.VOCABULARY)
    words = [("語言模型" * 300).encode(), b" " + b"internationalisation" * 100]
    probs = np.vstack([np.full((pieces.size, 1), 1e-6), np.zeros((1, 1))])
    found, lengths = pieces.lookup(words)
    assert np.isfinite(langid.forward(found, lengths, probs)).all()
    for w, word in enumerate(words):
        part, size = pieces.lookup([word])
        counts = langid.expected_counts(part, size, np.ones(1), np.zeros(1, np.int64), probs, pieces.size)
        covered = sum(n * len(pieces.names[i]) for i, n in enumerate(counts[:, 0]) if n)
        assert math.isclose(covered, len(word), rel_tol=1e-9)


def test_languages_without_spaces(spark):
    phrases = {
        "ja": ["私は学校へ行きます", "今日はとても寒いです", "電車が遅れています", "本を読んでいる", "明日また来てください", "東京の大学で勉強した"],
        "zh": ["我去学校读书", "今天天气非常冷", "火车已经晚点了", "他正在看一本书", "请你明天再来", "我们在北京大学学习"],
        "th": ["ฉันไปโรงเรียน", "วันนี้อากาศหนาวมาก", "รถไฟมาสาย", "เขากำลังอ่านหนังสือ", "พรุ่งนี้มาใหม่นะ", "เราเรียนที่กรุงเทพ"],
    }
    rng = np.random.default_rng(5)
    rows = [
        (k, "".join(rng.choice(phrases[lang], 12)), lang)
        for k, lang in enumerate(np.repeat(["ja", "zh", "th"], [60, 40, 20]).tolist())
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.identify(df, langid.fit_model(df.where("doc_id % 2 = 0"))).collect()
    wanted = {k: lang for k, _, lang in rows}
    assert all(r.lang_pred == wanted[r.doc_id] and r.score > 0.9 for r in found)
    signs = spark.createDataFrame([(1, "½ ² Ⅷ"), (2, "")], "doc_id long, text string")
    assert {r.lang_pred for r in langid.identify(signs, langid.fit_model(df)).collect()} == {"und"}


# --- context tree -------------------------------------------------------------------------------


def tree_by_recursion(units, weights, depth):
    """Probabilities of all bits by the definition of the tree, a node at a time."""
    counts: dict = {}
    for unit, n in zip(units, weights):
        for i, byte in enumerate(unit):
            context = bytes(max(0, depth - i)) + unit[max(0, i - depth) : i]
            for bit in range(8):
                node, value = (byte >> (8 - bit)) | (1 << bit), (byte >> (7 - bit)) & 1
                for d in range(depth + 1):
                    counts.setdefault((context[depth - d :], node), [0, 0])[value] += n
    children: dict = {}
    for context, node in counts:
        if context:
            children.setdefault((context[1:], node), set()).add(context)

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def log_pw(context, node):
        own = log_kt(*counts[context, node])
        below = children.get((context, node), ())
        if len(context) == depth:
            return own
        return np.logaddexp(own, sum(log_pw(c, node) for c in below)) - math.log(2)

    def one(context, node):
        a, b = counts[context[len(context) :] if False else context, node]
        return (b + 0.5) / (a + b + 1)

    def predict(context, node):
        p, deeper_seen = one(context, node), sum(counts[context, node]) > 0
        for d in range(depth - 1, -1, -1):
            c = context[depth - d :]
            w = math.exp(log_kt(*counts[c, node]) - math.log(2) - log_pw(c, node)) if deeper_seen else 1.0
            p, deeper_seen = w * one(c, node) + (1 - w) * p, sum(counts[c, node]) > 0
        return p

    out = []
    for unit in units:
        total = 0.0
        for i, byte in enumerate(unit):
            context = bytes(max(0, depth - i)) + unit[max(0, i - depth) : i]
            for bit in range(8):
                p = predict(context, (byte >> (8 - bit)) | (1 << bit))
                total += math.log10(p if (byte >> (7 - bit)) & 1 else 1 - p)
        out.append(total)
    return out


def test_word_scores_against_the_definition(spark):
    words = [(b"the", 40), (b"then", 3), (b"", 9), (b"of", 21), (b"often", 1), (b"unseen", 0), ("é".encode(), 2), (b"tententententen", 2)]
    df = spark.createDataFrame(words, "word binary, n long")
    found = {bytes(r.word): r.score for r in context_tree.word_scores(df).collect()}
    units = [w + b" " if w else b"\n" for w, _ in words]
    wanted = tree_by_recursion(units, [n for _, n in words], context_tree.DEPTH)
    assert np.allclose([found[w] for w, _ in words], wanted, rtol=1e-5)


def test_score_of_a_text_predicts_across_its_words(spark, monkeypatch):
    """Grams of whole texts against the definition; the same words in another order have another score."""
    texts = ["the cat sat on the mat", "the mat sat on the cat", "the cat  SAT\ton the mat", "", None, "mat the on sat cat the", "a é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = F.col("doc_id").isin(5, 6)
    units = [b"".join(w + b" " for w in (t or "").encode().lower().split()) + b"\n" for t in texts]
    wanted = tree_by_recursion(units, [0 if i in (5, 6) else 1 for i in range(len(units))], context_tree.DEPTH)
    for frequent, block, flush in ((2_000_000, 2_000_000, 4_000_000), (5, 30, 20), (0, 1, 1)):
        for name, value in (("FREQUENT_GRAMS", frequent), ("BLOCK", block), ("FLUSH", flush)):
            monkeypatch.setattr(context_tree, name, value)
        found = {r.doc_id: r.score for r in context_tree.score(docs, held).collect()}
        assert np.allclose([found[i] for i in range(len(texts))], wanted, rtol=1e-5)
    assert found[0] > found[5]


def test_texts_are_scored_in_slices_of_a_bounded_size(spark, monkeypatch):
    """What a task holds follows from the bytes of a slice, not from the rows of a batch; the scores are the same."""
    monkeypatch.setattr(context_tree, "CHUNK", 100)
    texts = ["x" * 60, None, "y" * 50, "", "z" * 300, "z", "z" * 99]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    found = [b.column(0).to_pylist() for b in context_tree._slices(iter([batch, batch.slice(0, 0)]), 0)]
    assert found == [["x" * 60, None], ["y" * 50, ""], ["z" * 300], ["z", "z" * 99]]
    docs = spark.createDataFrame([(i, f"the cat {i % 7} sat on {i % 5} mats") for i in range(200)], "doc_id long, text string").coalesce(1)
    held = F.col("doc_id") % 4 == 0
    monkeypatch.setattr(context_tree, "FREQUENT_GRAMS", 5)
    small = {r.doc_id: r.score for r in context_tree.score(docs, held).collect()}
    monkeypatch.setattr(context_tree, "CHUNK", 1 << 30)
    whole = {r.doc_id: r.score for r in context_tree.score(docs, held).collect()}
    assert len(small) == 200 and np.allclose([small[i] for i in range(200)], [whole[i] for i in range(200)], rtol=1e-6)


def test_scores_of_documents(spark, edges, nothing):
    held = F.coalesce(F.col("doc_id") == 9, F.lit(False))
    rows = context_tree.score(edges, held).collect()
    texts = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    counts, n = Counter(), 0
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t in texts}
    for i, t in texts:
        if i != 9:
            counts.update([*(t or "").encode().lower().split(), b""])
    n = sum(counts.values())
    assert len(rows) == len(texts)
    for r in rows:
        if r.doc_id is not None:
            words = tokens[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
            base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert context_tree.score(nothing, held).count() == 0


def test_frequent_and_joined_words_give_one_score(spark, monkeypatch):
    docs = documents(spark, "/root/testdata/sf0.001")
    held = fold(F.col("doc_id"), 7) == 2
    one = {r.doc_id: r for r in context_tree.score(docs, held).collect()}
    monkeypatch.setattr(context_tree, "FREQUENT_SHARE", 1 / 300)
    for r in context_tree.score(docs, held).collect():
        assert np.allclose([r.n_known, r.base_score, r.score], [one[r.doc_id].n_known, one[r.doc_id].base_score, one[r.doc_id].score])
    bits = [r.bits_per_byte for r in one.values() if r.held_out]
    assert np.mean(bits) < 3.2  # a byte of these texts, without a model: 8


# --- toxicity -----------------------------------------------------------------------------------


def test_gradient_of_the_network():
    net = toxicity.Net()
    weights, rng = toxicity.Weights.new(net), np.random.default_rng(0)
    weights.p = {k: v.astype(float) for k, v in weights.p.items()}
    x, mask, y = rng.standard_normal((3, 6, net.inputs)), np.ones((3, 6)), np.array([1.0, 0.0, 1.0])
    mask[0, 4:] = 0
    _, g, d_x = weights.gradient(x, mask, y)
    for name in ("in_f", "rec_f", "rec_b", "bias_b", "attend", "attend_v", "out", "bias"):
        at = tuple(rng.integers(0, s) for s in weights.p[name].shape)
        old, loss = weights.p[name][at], []
        for step in (1e-3, -1e-3):
            weights.p[name][at] = old + step
            loss.append(weights.gradient(x, mask, y)[0])
        weights.p[name][at] = old
        assert abs((loss[0] - loss[1]) / 2e-3 - g[name][at]) < 1e-5
    assert not d_x[0, 4:].any()


def test_windows_cover_each_word():
    net = toxicity.Net()
    for n in (0, 1, 23, 24, 25, 40, 41, 500):
        at = toxicity.starts(n, net)
        covered = {k for a in at for k in range(a, a + net.window)}
        assert covered >= set(range(n)) and (n <= net.window or at[-1] == n - net.window)


def test_toxic_documents_are_found():
    rnd = random.Random(4)

    def text(toxic):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(30, 300))]
        for _ in range(max(2, len(words) // 25) if toxic else 0):
            words[rnd.randrange(len(words))] = rnd.choice(["vile", "Rotten", "scummy"])
        return " ".join(words)

    truth = np.array([int(rnd.random() < 0.3) for _ in range(700)])
    texts = [toxicity.words_of(text(t)) for t in truth]
    weights = toxicity.train(texts[:400], truth[:400], toxicity.Net())
    scores = toxicity.Scorer(weights)(texts[400:])
    assert ((scores >= 0.3) == truth[400:]).mean() > 0.95


def test_all_windows_of_the_sample_are_tried():
    """A document is trained and calibrated by the windows by which it is scored."""
    net = toxicity.Net()
    rnd = random.Random(6)
    texts = [[b"w%d" % rnd.randrange(300) for _ in range(n)] for n in (0, 5, 24, 700, 5000)]
    data = toxicity._Sample(texts, net)
    assert data.counts.tolist() == [len(toxicity.starts(len(t), net)) for t in texts] == np.bincount(data.owner).tolist()
    weights = toxicity.Weights.new(net)
    weights.calibration = np.array([1.0, 0.0, 0.0])
    logits = data.logits(weights)
    scores = toxicity._sigmoid(logits[data.best(logits)])
    assert np.allclose(scores, toxicity.Scorer(weights)(texts), atol=1e-6)


def test_each_window_start_is_scored():
    """Words before a text do not change which of its passages are seen whole."""
    net = toxicity.Net()
    assert all(toxicity.starts(n, net).tolist() == list(range(max(1, n - net.window + 1))) for n in (0, 23, 24, 25, 200))
    weights = toxicity.Weights.new(net)
    x = np.random.default_rng(2).standard_normal((50, net.inputs)).astype(np.float32)
    ids = np.random.default_rng(3).integers(0, 50, 5000)
    projected = weights.project(x)
    windows = np.lib.stride_tricks.sliding_window_view(ids, net.window)
    each = weights.run({d: projected[d][windows] for d in "fb"}, None)[0]
    for threads in (1, 2):
        assert np.allclose(weights.from_each_word(weights.halved(projected), ids, threads), each, atol=1e-5)


def slow_logit(weights, words):
    """A window by the equations of the network, a number at a time."""
    p, h_size = {k: v.astype(float) for k, v in weights.p.items()}, weights.net.hidden
    sigmoid = lambda v: 1 / (1 + math.exp(-v))

    def inputs(word):
        row, grams, _ = toxicity.features([word], weights.net)
        return p["word"][row[0]] + sum(p["char"][g] for g in grams) / len(grams)

    states = [[None, None] for _ in words]
    for way, (d, order) in enumerate((("f", range(len(words))), ("b", range(len(words) - 1, -1, -1)))):
        h = [0.0] * h_size
        for t in order:
            x = inputs(words[t]) @ p[f"in_{d}"] + p[f"bias_{d}"]
            u = [sum(h[i] * p[f"rec_{d}"][i, j] for i in range(h_size)) for j in range(3 * h_size)]
            z = [sigmoid(x[j] + u[j]) for j in range(h_size)]
            r = [sigmoid(x[j] + u[j]) for j in range(h_size, 2 * h_size)]
            new = [math.tanh(x[2 * h_size + j] + r[j] * u[2 * h_size + j]) for j in range(h_size)]
            h = [(1 - z[j]) * new[j] + z[j] * h[j] for j in range(h_size)]
            states[t][way] = h
    both = [np.array(f + b) for f, b in states]
    weight = [math.exp(sum(math.tanh(s @ p["attend"][:, k]) * p["attend_v"][k] for k in range(weights.net.attention))) for s in both]
    pool = sum(w * s for w, s in zip(weight, both)) / sum(weight)
    return pool @ p["out"] + p["bias"][0]


def test_scores_against_a_slow_reference():
    """A document's score is that of its greatest window, calibrated with the number of its windows."""
    net = toxicity.Net()
    weights, rnd = toxicity.Weights.new(net), random.Random(8)
    weights.calibration = np.array([0.7, -0.2, 0.1])
    texts = [" ".join(rnd.choice(["Oak", "elm", "\u00c9b\u00e9ne", "yew-tree", "fir,"]) for _ in range(n)) for n in (1, 3, net.window, net.window + 1, 40)]
    for text, score in zip(texts, toxicity.Scorer(weights)([toxicity.words_of(t) for t in texts])):
        words = toxicity.words_of(text)
        n = max(1, len(words) - net.window + 1)
        best = max(slow_logit(weights, words[k : k + net.window]) for k in range(n))
        assert math.isclose(score, 1 / (1 + math.exp(-(0.7 * best - 0.2 * math.log(n) + 0.1))), abs_tol=1e-5)


def test_toxicity_edges(spark, edges, nothing):
    assert toxicity.fit_model(edges, labels(spark, SF_DIR).limit(0)) is None
    weights = toxicity.train([[b"a", b"b"], [b"c"]] * 20, np.array([1, 0] * 20), toxicity.Net(epochs=1, steps=1))
    rows = toxicity.toxicity(edges, weights, F.lit(False)).collect()
    assert len(rows) == edges.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.toxicity(nothing, weights).count() == 0
    assert {r.score for r in toxicity.toxicity(edges, None).collect()} == {0.0}


# --- quality ------------------------------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    rows = queries.op3_cotraining(spark, SF_DIR).join(labels(spark, SF_DIR), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.kept == (r.quality == 1) for r in held]) > 0.9


def test_cotraining_uses_the_pool():
    """With few labels the views teach each other what the unlabelled documents show."""
    rng = np.random.default_rng(5)
    n = 3000
    y = rng.integers(0, 2, n)
    text, meta = (np.hstack([rng.standard_normal((n, 20)) + 0.9 * (2 * y[:, None] - 1) * np.eye(1, 20), rng.standard_normal((n, 3))]) for _ in range(2))
    fit = cotraining.Fit(steps=100)
    part = slice(0, 200)
    alone = cotraining.cotrain((text[part], meta[part], y[part]), (text[:0], meta[:0]), fit)
    taught = cotraining.cotrain((text[part], meta[part], y[part]), (text[200:2000], meta[200:2000]), fit)

    def right(model):
        return ((model.scores(text[2000:], meta[2000:])[0] >= 0.5) == y[2000:]).mean()

    assert right(taught) >= right(alone) - 0.02 and right(taught) > 0.75


@pytest.mark.parametrize("with_model", [True, False])
def test_quality_edges(spark, edges, nothing, with_model):
    model = None
    if with_model:
        rows = [(i, ("good words here " * 9 if i % 2 else "### *** %%%"), None, "s", i % 2) for i in range(60)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, quality int")
        model = cotraining.fit_model(df, df.select("doc_id", "quality"))
        assert model is not None
    rows = cotraining.quality(edges, model).collect()
    assert len(rows) == edges.count() and all(0 <= r.score <= 1 for r in rows)
    assert cotraining.quality(nothing, model).count() == 0
    assert with_model or all(r.kept for r in rows)


def test_grams_move_and_are_written_as_runs(spark, monkeypatch):
    """The table of counts is rows of whole groups of the tree; the runs of texts' other grams are not written."""
    flipped = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, np.uint64) & np.uint64(0xFF03FFFFFFFFFFFF))
    monkeypatch.setattr(context_tree, "ROW", 100)
    table = context_tree._count_rows(flipped, np.arange(len(flipped)))
    rows = list(context_tree._rows_of(iter(table.to_batches())))
    nears = [set(context_tree._near(keys).tolist()) for keys, _ in rows]
    assert len(rows) > 5 and sum(map(len, nears)) == len(set.union(*nears))
    assert all(len(keys) >= 100 and (np.diff(keys.astype(float)) >= 0).all() for keys, _ in rows[:-1])
    found = {k: n for keys, times in rows for k, n in zip(keys.tolist(), times.tolist())}
    assert found == dict(zip(flipped.tolist(), range(len(flipped))))
    written, store = {}, context_tree.stored
    monkeypatch.setattr(context_tree, "stored", lambda df, purpose: written.setdefault(purpose, store(df, purpose)))
    monkeypatch.setattr(context_tree, "FREQUENT_GRAMS", 5)
    texts = [f"the cat {i} sat on {i % 5} mats" for i in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert context_tree.score(docs, F.col("doc_id") % 4 == 0).count() == 50
    assert not any("gram" in df.columns or ("part" in df.columns and "owners" in df.columns) for df in written.values())
    assert sum(df.count() for name, df in written.items() if name == "grams") < 50
