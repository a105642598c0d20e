import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from playledger.llm import capfilters, pivotcodes
from tests.util import bag

SCHEMA = "vec_id bigint, embedding array<float>, label int, rep string, cap string, n_links string"


def _vectors(seed, groups, alone, dim=64, near=0.975):
    """Unit vectors: groups of near copies of a given size, and others; with labels."""
    rng = np.random.default_rng(seed)
    found = []
    for label, size in groups:
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            e = rng.standard_normal(dim)
            e -= e @ centre * centre
            found.append((near * centre + math.sqrt(1 - near * near) * e / np.linalg.norm(e), label))
    found += [(rng.standard_normal(dim), int(rng.integers(3))) for _ in range(alone)]
    return [(v.astype(np.float32).tolist(), label) for v, label in found]


EDGES = [
    (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [], 1),
    (7, [1.0, None], 1), (8, [float("nan"), 1.0], 1), (9, [float("inf"), 1.0], 1), (10, [1.0, 0.0], None),
    (11, [1.0, 0.0], 2), (12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (13, [3e38, 1e30], 1),
    (14, [-0.0, 5.0], 1), (None, None, None), (15, [0.1] * 500, 1), (16, [0.1] * 500, 1),
]


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def _linked(rows):
    """``vec_id, n_links, component_id`` by comparing all rows."""
    good = [
        v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v, label in rows
    ]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if g else None for (_, v, _), g in zip(rows, good)]
    near = [
        [
            bool(i != j and good[i] and good[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93)
            for j in range(len(rows))
        ]
        for i in range(len(rows))
    ]
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            at = todo.pop()
            new = {j for j in range(len(rows)) if near[at][j]} - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((row[0], int(sum(near[i])), least, row[0] == least))
    return out


@pytest.mark.parametrize("block", [4, 512])
def test_near_vectors_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(capfilters, "BLOCK", block)
    found = _vectors(1, [(0, 40), (0, 7), (1, 3), (2, 2), (2, 2)], 120)
    rows = [(1000 - i, v, label) for i, (v, label) in enumerate(found)]
    # Equal vectors, under the same label and under another.
    rows += [(2000 + i, rows[i % 3][1], rows[i % 3][2]) for i in range(9)] + [(3000, rows[0][1], 2)]
    assert bag(capfilters.near_vectors(_table(spark, rows))) == Counter(_linked(rows))


def test_near_vectors_edges(spark):
    got = bag(capfilters.near_vectors(_table(spark, EDGES + EDGES[:2])))
    assert got == Counter(_linked(EDGES + EDGES[:2]))
    assert capfilters.near_vectors(_table(spark, [])).collect() == []
    assert capfilters.near_vectors(_table(spark, [(1, None, 1)])).collect() == [(1, 0, 1, True)]


@pytest.mark.parametrize("rows", [100, 5_000, 100_000])
def test_recall_of_pairs_at_the_threshold(rows):
    """However many caps there are, pairs of exactly 0.93 share one in all but a few of a thousand cases."""
    caps = capfilters.Caps()
    size = caps.size(rows)
    rng = np.random.default_rng(rows)
    x = capfilters.unit(rng.standard_normal((1000, 64)))
    e = rng.standard_normal((1000, 64))
    e = capfilters.unit(e - (e * x).sum(axis=1, keepdims=True) * x)
    left, right = capfilters.decode(x, size, caps), capfilters.decode(0.93 * x + math.sqrt(1 - 0.93**2) * e, size, caps)
    missed = sum(not len(np.intersect1d(a, b)) for a, b in zip(left, right))
    assert missed <= 12
    held = np.mean([len(a) for a in left])
    assert 0.8 * caps.filters < held < 1.25 * caps.filters


def test_decode_finds_all_caps():
    """List decoding against the products with every direction."""
    caps = capfilters.Caps(codes=2)
    x = capfilters.unit(np.random.default_rng(3).standard_normal((20, 32)))
    alpha, made = capfilters._codes(32, 64, caps)
    whole = np.concatenate([((x @ a)[:, :, None] + (x @ b)[:, None, :]).reshape(20, -1) for a, b in made], axis=1)
    for caps_of, row in zip(capfilters.decode(x, 64, caps), whole):
        assert caps_of.tolist() == np.flatnonzero(row >= alpha).tolist()


def _compressed(rows):
    """Codes by plain integer arithmetic, each part beside each entry."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = max(8, -(-max(len(r[1]) for r in kept) // 8) * 8)
    clip = lambda x: max(-(2**27), min(2**27, x))
    ints = [[clip(math.floor(4096 * x)) for x in r[1]] + [0] * (dim - len(r[1])) for r in kept]
    step = dim // 8
    parts = [[x[i * step : (i + 1) * step] for i in range(8)] for x in ints]
    books = [[parts[j][i] for j in range(min(16, len(kept)))] for i in range(8)]

    def assign():
        found = []
        for row in parts:
            distances = [[sum((a - b) ** 2 for a, b in zip(part, e)) for e in book] for part, book in zip(row, books)]
            found.append([(min(d), d.index(min(d))) for d in distances])
        return found

    for _ in range(6):
        found = assign()
        books = [
            [
                [sum(c) // len(m) for c in zip(*m)] if (m := [row[i] for row, f in zip(parts, found) if f[i][1] == k]) else e
                for k, e in enumerate(book)
            ]
            for i, book in enumerate(books)
        ]
    found = assign()
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return [(r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], sha) for r, f, e in zip(kept, found, errors)]


def test_compress_against_brute_force(spark):
    rows = [(i, v, label) for i, (v, label) in enumerate(_vectors(5, [(0, 30), (1, 5)], 60, dim=16))]
    rows += [(500, rows[3][1], None), (501, rows[3][1], None), (3, rows[9][1], 1)]
    got = pivotcodes.compress(_table(spark, rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert bag(got) == Counter(_compressed(rows))


def test_compress_edges(spark):
    rows = [r for r in EDGES if r[0] not in (13, 15, 16)]
    assert bag(pivotcodes.compress(_table(spark, rows))) == Counter(_compressed(rows))
    few = [(1, [1.0] * 9, 1), (2, [3e38] * 9, None)]
    assert bag(pivotcodes.compress(_table(spark, few))) == Counter(_compressed(few))
    for none in ([], [(1, None, 1)]):
        got = pivotcodes.compress(_table(spark, none))
        assert got.collect() == [] and got.columns[-1] == "codebooks_sha256"


def test_pivots_skip_most_distances_and_change_nothing():
    rng = np.random.default_rng(8)
    book = rng.integers(-5000, 5000, (16, 8))
    parts = np.concatenate([book[rng.integers(0, 16, 3000)] + rng.integers(-200, 200, (3000, 8)), book, (book[:8] + book[8:]) // 2])
    pivots = pivotcodes.pick_pivots(book)
    far = np.sqrt(pivotcodes._squares(parts, pivots).astype(float))
    index, best, evaluated = pivotcodes.nearest(parts, far, book, pivots)
    squares = pivotcodes._squares(parts, book)
    assert index.tolist() == squares.argmin(axis=1).tolist() and best.tolist() == squares.min(axis=1).tolist()
    assert evaluated < 0.3 * squares.size
    # Equal entries: the lower index.
    same = np.zeros((16, 8), np.int64)
    assert set(pivotcodes.nearest(parts, far * 0 + 1.0, same, same[:4])[0]) == {0}
