"""The stages of the pipeline, each on what the one before kept."""

import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer
import public_tokenizers

import corpus_pipeline
from playledger.llm import bpe, langid, setsketch
from playledger.llm.common import documents, stored
from tests.llm.test_duplicates import forest, word_sets
from tests.llm.test_tokens import check_packed

SF_DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "passages", "packing"]
    docs = [documents(spark, SF_DIR)]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF_DIR), name))
    assert all(d.columns == docs[0].columns for d in docs[:-1])
    texts = [{r.doc_id: r.text for r in d.collect()} for d in docs[:-1]]
    # Clean documents stay.
    assert all(i in texts[1] for i, t in texts[0].items() if len(t.split()) >= 20)
    by_text = defaultdict(list)
    for i, t in texts[1].items():
        by_text[t].append(i)
    assert texts[2] == {max(ids): t for t, ids in by_text.items()}
    sets = word_sets(texts[2], 5)
    pairs = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    ]
    wanted = forest(pairs, sets)
    assert set(texts[3]) == {i for i in sets if wanted[i] == i}
    words = {i: t.lower().split() for i, t in texts[3].items()}
    spots = defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 49):
            spots[tuple(w[k : k + 50])].add(i)
    repeated = {i for ids in spots.values() if len(ids) > 1 for i in ids}
    own = {i for i, w in words.items() if len({tuple(w[k : k + 50]) for k in range(len(w) - 49)}) < len(w) - 49}
    assert all(texts[4][i] == t for i, t in texts[3].items() if i not in repeated | own)
    assert all(r.n_chars == len(r.text) for r in docs[4].collect())
    check_packed(docs[5].collect(), texts[4], Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER)))


def test_edges(spark, edges):
    docs = edges
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_DIR), name)
        assert name == "packing" or docs.columns == before.columns


def test_clean_rows_with_a_null_or_repeated_id_survive(spark):
    """What happens to one row of an id, or of none, does not happen to the others."""
    rnd = random.Random(3)
    base = [r.text for r in documents(spark, SF_DIR).where("lang = 'en' AND length(text) > 200").orderBy("doc_id").limit(40).collect()]
    pool = sorted({w for t in base for w in t.split()})

    def words(k):
        return " ".join(rnd.choice(pool) for _ in range(k))

    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def frame(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)

    def kept(stage, rows):
        return {(r.doc_id, r.text) for r in stage(spark, frame(rows), SF_DIR).collect()}

    learn = [(100 + k, t) for k, t in enumerate(base)]
    bad = [(None, "12 34 !"), (100, "... 5")]
    clean = [(None, base[1]), (None, base[2])]
    assert kept(corpus_pipeline.language, learn + clean + bad) >= {*clean, learn[0]}
    assert not kept(corpus_pipeline.language, learn + clean + bad) & {*bad}
    a, b, c, d, e = (words(60) for _ in range(5))
    rows = [(1, a), (None, a.upper()), (None, b), (None, c), (2, d), (3, d + " more"), (3, e), (2, e + " more")]
    assert kept(corpus_pipeline.near, rows) == {(1, a), (None, b), (None, c), (2, d), (2, e + " more")}
    assert kept(corpus_pipeline.exact, [(1, a), (None, a), (None, b), (2, a), (2, c)]) == {(None, b), (2, a), (2, c)}
    one, two, other = f"{words(30)} {a} {words(30)}", f"{words(20)} {a} {words(20)}", words(200)
    rows = [(1, one), (2, two), (2, other), (None, b), (None, c)]
    found = kept(corpus_pipeline.passages, rows)
    cut = " ".join(two.split()[:20] + two.split()[80:])
    assert found == {(1, one), (2, cut), (2, other), (None, b), (None, c)}
    # Two texts of one id that share a passage: one of them keeps it.
    found = kept(corpus_pipeline.passages, [(1, one), (1, two)])
    assert len(found) == 2 and sum(a in t for _, t in found) == 1


def test_every_stage_takes_an_empty_table(spark, nothing):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, "")
        assert out.count() == 0, name
        assert name == "packing" or out.columns == nothing.columns, name


class Captured:
    """In place of documents: gives the function that tasks run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def held_mb() -> float:
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_workers_hand_back_what_a_task_held(spark):
    """What a Python worker keeps after its task stands beside the memory of all later steps."""
    model = langid.Model(["de", "en"], np.array([0.5, 0.5]), np.full((langid.pieces(langid.Fit().vocabulary).size + 1, 2), 1e-5), langid.Fit())

    def batches():
        for k in range(3):
            texts = [f"{i} {k} " + "a few words again " * 400 for i in range(300)]
            yield pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], names=["doc_id", "text"])

    for run in (setsketch.sketches(Captured(), setsketch.Near(bands=2)), langid.identify(Captured(), model)):
        for first in (True, False):
            before = held_mb()
            rows = sum(out.num_rows for out in run(batches()))
            if not first:  # the first time loads what stays
                assert rows == 900 and held_mb() - before < 10
        large = [pa.array(["x" * 1000] * 20_000) for _ in range(3)]
        before = held_mb()
        del large
        assert sum(out.num_rows for out in run(iter([]))) == 0 and before - held_mb() > 40
