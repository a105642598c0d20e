"""Near-duplicates, components and repeated passages against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from playledger.llm import common, setsketch, suffixes
from playledger.llm.components import components
from playledger.llm.setsketch import Near, near_duplicates


def forest(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(30)] + [(100 + i, 101 + i) for i in range(40)]
    pairs += [(200, 200 + i) for i in range(50)]
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert found == forest([p for p in pairs if p[0] != p[1]], nodes)


def word_sets(texts, size):
    out = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        out[i] = {tuple(w)} if 0 < len(w) < size else {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
    return out


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    """Many texts at similarities about the threshold, some of which only a second look can link."""
    rnd = random.Random(7)
    texts, n = {}, 0
    for size in (4, 30, 80, 200):
        for _ in range(6):
            base = [f"w{rnd.randrange(3000)}" for _ in range(size)]
            for _ in range(6):
                words = list(base)
                for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, size // 20, size // 12])):
                    words[rnd.randrange(size)] = f"z{rnd.randrange(10**6)}"
                texts[n] = " ".join(w.upper() if rnd.random() < 0.1 else w for w in words)
                n += 1
    texts |= {n: None, n + 1: "", n + 2: "a", n + 3: "A", n + 4: "a b", n + 5: "a b c"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(setsketch, "BLOCK", 4)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()}
    sets = word_sets(texts, 3)
    pairs = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    wanted = forest(pairs, sets)
    assert len(pairs) > 50
    assert found == {i: (len(sets[i]), wanted[i], wanted[i] == i) for i in sets}


def test_many_blocks_are_compared_at_once(monkeypatch):
    """Pairs of several groups together are those of each group by itself, and the plain way to rule out a pair agrees with the grid."""
    near = Near()
    rng = np.random.default_rng(5)
    rows = []
    for key, count in enumerate((1, 2, 40, 1, 7)):
        base = rng.integers(0, 50, near.registers)
        for rep in range(count):
            sketch = np.where(rng.random(near.registers) < rng.choice([0.1, 0.3, 0.5]), rng.integers(0, 50, near.registers), base)
            sketch[: near.rows] = base[: near.rows]
            rows.append((key, 0, 0, key % 2, 100 * key + rep, int(rng.integers(0, 6)), rep % 2, sketch.astype("<u2").tobytes(), int(rng.integers(90, 110))))
    names = [n.split()[0] for n in setsketch._BLOCK_ROW.split(", ")]
    table = pa.table(dict(zip(names, map(list, zip(*rows)))))
    first = np.flatnonzero(np.diff(table.column("key").to_numpy(), prepend=-1))
    sketches = [np.frombuffer(r[7], "<u2") for r in rows]
    cut, wanted = setsketch._deviations_below(near), set()
    for i, x in enumerate(rows):
        for j in range(i + 1, len(rows)):
            y = rows[j]
            if x[0] == y[0] and x[5] != y[5] and (x[2] == x[3] or x[6] != y[6]) and 100 * min(x[8], y[8]) >= 85 * max(x[8], y[8]):
                greater, smaller = ((a > b).sum() for a, b in ((sketches[i], sketches[j]), (sketches[j], sketches[i])))
                if setsketch.estimate(*(np.array([v]) for v in (greater, smaller, x[8], y[8])), near)[0] >= cut:
                    wanted.add((i, j))
    assert len(wanted) > 50
    for pairs in (1, 16, 10_000):
        monkeypatch.setattr(setsketch, "PAIRS", pairs)
        found = [(i, j) for at, to in setsketch._open_pairs(table, first, near) for i, j in zip(at.tolist(), to.tolist())]
        assert len(found) == len(set(found)) and set(found) == wanted


def test_registers_merge_and_estimate():
    near = Near(bands=64)
    rng = np.random.default_rng(3)
    for j in (0.5, 0.85):
        both = rng.integers(0, 2**63, 4000).astype(np.uint64)
        more = int(4000 * (1 - j) / (2 * j))
        x = np.unique(np.append(both, rng.integers(0, 2**63, more).astype(np.uint64)))
        y = np.unique(np.append(both, rng.integers(0, 2**63, more).astype(np.uint64)))
        a, b = setsketch.registers(x, near), setsketch.registers(y, near)
        assert (setsketch.registers(np.union1d(x, y), near) == np.maximum(a, b)).all()
        found = setsketch.estimate(np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([len(x)]), np.array([len(y)]), near)
        assert abs(found[0] - j) < 5 * (j * (1 - j) / near.registers) ** 0.5


def test_near_duplicate_edges(spark, edges, nothing):
    rows = near_duplicates(edges).collect()
    assert len(rows) == edges.count()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert by[1] == {(0, 1, True)} and by[2] == {(0, 2, True)}
    assert by[5] == {(4, 5, True)} and by[6] == by[7] == {(4, 5, False)} and by[10] == {(*[x[0] for x in by[4]], 4, False)}
    assert by[None] == {(4, 5, False), (0, None, True)}
    assert near_duplicates(nothing).count() == 0


def planted(seed):
    rnd = random.Random(seed)

    def words(k):
        return [f"w{rnd.randrange(5000)}" for _ in range(k)]

    passages = [words(k) for k in (49, 50, 51, 60, 120, 300)]
    docs = {}
    for i in range(40):
        parts = []
        for _ in range(rnd.randrange(4)):
            parts += words(rnd.choice([0, 3, 40, 200])) + rnd.choice(passages)
        docs[i] = parts + words(rnd.choice([0, 5, 90]))
    docs[40] = docs[3] + docs[5]
    docs[41] = passages[3] * 3
    return docs


@pytest.mark.parametrize("seed, parts", [(1, "4"), (2, "37")])
def test_repeats_against_brute_force(spark, seed, parts):
    docs = planted(seed)
    df = spark.createDataFrame([(i, " \n".join(w)) for i, w in docs.items()], "doc_id long, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = suffixes.repeats(df).collect()
        cut = {r.doc_id: r.text.split() for r in suffixes.without_duplicates(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    at = defaultdict(list)
    for i, w in sorted(docs.items()):
        for k in range(len(w) - 49):
            at[tuple(w[k : k + 50])].append((i, k))
    repeated, later = defaultdict(set), defaultdict(set)
    for spots in at.values():
        if len(spots) > 1:
            for n, (i, k) in enumerate(sorted(spots)):
                repeated[i].update(range(k, k + 50))
                if n:
                    later[i].update(range(k, k + 50))
    found, duplicate = defaultdict(set), defaultdict(set)
    for r in rows:
        (duplicate if r.duplicate else found)[r.doc_id].update(range(r.start_word, r.end_word))
    assert found == repeated
    assert duplicate == {i: w for i, w in later.items() if w}
    # No word is lost, and documents without duplicates stay as they are.
    assert {x for w in cut.values() for x in w} == {x for w in docs.values() for x in w}
    assert all(i in cut or not docs[i] or duplicate[i] for i in docs)
    assert all(cut[i] == docs[i] for i in docs if not duplicate[i] and i in cut)


def test_passages_among_fragments(spark):
    """Texts that share 49 words with a text stand between it and the one with which it shares 50."""
    rnd = random.Random(11)
    docs, wanted = {}, defaultdict(set)

    def words(k):
        return [f"w{rnd.randrange(10**6)}" for _ in range(k)]

    for group in range(30):
        n = 100 * group
        docs[n] = words(150)
        docs[n + 1] = words(20) + docs[n][50:100] + words(20)
        wanted[n].update(range(50, 100))
        wanted[n + 1].update(range(20, 70))
        for k in range(12):
            at = rnd.randrange(102)
            docs[n + 2 + k] = words(20) + docs[n][at : at + 49] + words(20)
    found, duplicate = defaultdict(set), defaultdict(set)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    for r in suffixes.repeats(df).collect():
        (duplicate if r.duplicate else found)[r.doc_id].update(range(r.start_word, r.end_word))
    # Fragments may share 50 words with each other, as the text's.
    at = defaultdict(list)
    for i, w in sorted(docs.items()):
        for k in range(len(w) - 49):
            at[tuple(w[k : k + 50])].append((i, k))
    repeated, later = defaultdict(set), defaultdict(set)
    for spots in at.values():
        for n, (i, k) in enumerate(spots if len(spots) > 1 else []):
            repeated[i].update(range(k, k + 50))
            if n:
                later[i].update(range(k, k + 50))
    assert all(repeated[i] >= w for i, w in wanted.items())
    assert found == {i: w for i, w in repeated.items() if w} and duplicate == {i: w for i, w in later.items() if w}


def test_passages_of_rows_without_an_id(spark):
    """They come last, so they are the ones that are cut; two texts under one id are compared, too."""
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, f"{text} a"), (None, f"b {text}"), (3, f"{text} c"), (3, f"{text} c"), (7, f"d {text}"), (7, f"e e {text}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.start_word, r.end_word, r.duplicate) for r in suffixes.repeats(df).collect())
    spans = [(3, 0), (7, 1), (7, 2), (-1, 0), (-1, 1)]
    wanted = [(i, at, at + 60, False) for i, at in spans] + [(i, at, at + 60, True) for i, at in spans[1:]]
    assert found == sorted(wanted)
    cut = sorted(r.text for r in suffixes.without_duplicates(df).collect())
    assert cut == sorted(["a", "b ", "d ", "e e ", f"{text} c", f"{text} c"])


def test_blocks_of_sorted_suffixes(spark, monkeypatch):
    """However few suffixes are compared at once, the same passages are found."""
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in planted(3).items()], "doc_id long, text string").coalesce(1)
    whole = sorted(suffixes.repeats(df).collect())
    monkeypatch.setattr(suffixes, "_BLOCK", 3)
    assert sorted(suffixes.repeats(df).collect()) == whole


def test_passage_edges(spark, edges, nothing):
    rows = suffixes.repeats(edges).collect()
    assert {r.doc_id for r in rows} == {4, 10}
    kept = suffixes.without_duplicates(edges)
    assert kept.columns == edges.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    # Of document 10 no word is left: all of it stands in document 4.
    assert set(ids) == {1, 2, 3, 4, 5, 6, 7, 8, 9, None}
    assert suffixes.repeats(nothing).count() == 0 and suffixes.without_duplicates(nothing).count() == 0


def test_texts_move_once_to_meet_their_cuts(spark):
    """Where the cuts are too many to be broadcast, the texts are shuffled once for them, not once each for those with and without."""
    passage = " ".join(f"p{k}" for k in range(60))
    df = spark.createDataFrame([(1, f"a {passage}"), (2, f"b {passage} c"), (3, "d"), (4, passage), (None, passage), (5, None)], "doc_id long, text string")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = suffixes.without_duplicates(df)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("SortMergeJoin") == 1
        assert sorted(out.collect(), key=str) == sorted([(1, f"a {passage}"), (2, "b c"), (3, "d"), (5, None)], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)


@pytest.mark.parametrize("slots", [1 << 15, 1 << 23])
def test_texts_without_a_likely_partner_do_not_move(spark, monkeypatch, slots):
    """Sets are made before the join, of those whose slot is taken, and are those of the wanted ids, however few slots there are."""
    monkeypatch.setattr(common, "SLOTS", slots)
    docs = spark.range(3000).selectExpr("CASE WHEN id < 2990 THEN id - 5 END AS doc_id", "concat('a b c d ', id) AS text")
    reps = spark.range(0, 3000, 3).selectExpr("id AS rep")
    found = setsketch._sets(docs, reps, Near())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftSemi") < plan.index("MapInArrow")
    assert {r.rep: r.hashes for r in found.collect()} == {
        k: bytearray(setsketch.shingles(f"a b c d {k + 5}", 3).tobytes()) for k in range(0, 2985, 3)
    }
