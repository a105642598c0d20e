import re
from collections import Counter

import pytest

from playledger.llm import divergence
from tests.util import bag

SCHEMA = "doc_id bigint, text string, lang string, source string, item string, p string, count string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, *r, "x", "x", "x") for i, r in enumerate(rows)], SCHEMA)


def _audit(rows):
    """The contract by plain loops over all kept terms."""
    docs = []
    for text, lang, source in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        docs.append((lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower))))
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        often = Counter(t for _, _, c in mine for t in c)
        kept = sorted(t for t, n in often.items() if n >= 3)

        def shares(some):
            counts = {t: sum(c[t] for _, _, c in some) for t in kept}
            n = sum(counts.values())
            return counts, {t: 1 + 10**9 * (counts[t] + 1) // (n + len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // q
        whole = shares(mine)[1]
        by = {s: shares([d for d in mine if d[1] == s]) for s in {d[1] for d in mine}}
        for source, (counts, p) in by.items():
            pairs = [(o, sum(f(p[t], q[t]) for t in kept)) for o, (_, q) in by.items() if o != source]
            terms = [(t, f(p[t], whole[t])) for t in kept if counts[t] and p[t] > whole[t]]
            for part, found, ranks in (("pair", pairs, None), ("term", terms, 200)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, item, v, k) for k, (item, v) in enumerate(found[:ranks], 1)]
    return out


ROWS = (
    [(f"Alpha beta{'' if i % 3 else ' Gamma'} w{chr(97 + i % 26)} ÉCLAIR é 漢字 beta", "en", f"s{i % 4}") for i in range(40)]
    + [(f"uno dos {'tres ' * (i % 5)}", "es", f"s{i % 3}") for i in range(12)]
    + [(None, None, None), ("", "en", "empty"), ("1 2 3", "en", "s1"), ("only once", "de", "a"), ("x y", "de", "b")]
    + [("zeta " * 20_000 + "漢" * 30_000, "en", "s9"), ("zeta alpha", "en", None), ("zeta", "en", None), ("zeta", "en", None)]
    + [("", None, "z"), ("Zeta", None, "z"), ("zeta", None, "y"), ("ZETA", None, "y")]
)


@pytest.mark.parametrize("block_bytes, chunk_rows, shards", [(96_000_000, 4096, 4), (2_000, 3, 7), (1, 1, 1)])
def test_audit_against_brute_force(spark, block_bytes, chunk_rows, shards):
    """Also with memory so small that many runs are merged."""
    got = divergence.audit(_docs(spark, ROWS).repartition(5), shards, block_bytes, chunk_rows)
    assert bag(got) == Counter(_audit(ROWS))


def test_many_terms_keep_200_ranks(spark):
    word = lambda i: "".join(chr(97 + (i // 26**k) % 26) for k in range(3))
    rows = [(" ".join(f"{word(i)} " * (1 + i % 7) for i in range(600)), "en", s) for s in ("a", "a", "b")]
    rows += [(" ".join(word(i) for i in range(0, 600, 2)), "en", "c")] * 2
    got = divergence.audit(_docs(spark, rows))
    assert bag(got) == Counter(_audit(rows))


def test_audit_edges(spark, edges, nothing):
    rows = [(r["text"], r["lang"], r["source"]) for r in edges.collect()]
    assert bag(divergence.audit(edges)) == Counter(_audit(rows))
    assert divergence.audit(nothing).collect() == []


def test_terms_of_long_texts():
    text = "Ab-cd\x7féÉ Z" * 9_000
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    parts = list(divergence.terms_of(text.encode()))
    assert len(parts) > 1
    assert [t.decode() for part in parts for t in part] == re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def test_more_sources_than_a_task_holds(spark, monkeypatch):
    """Also where the sources of a term are merged in several parts."""
    monkeypatch.setattr(divergence, "SOURCES", 100)
    rows = [(f"alpha {'beta ' * (i % 4)} {'gamma' if i % 9 else ''} w{chr(97 + i % 26)}", "en", f"s{i}") for i in range(700)]
    assert bag(divergence.audit(_docs(spark, rows), 3, 4_000)) == Counter(_audit(rows))


def test_shares_are_exact_at_any_count(spark):
    n, v, count = 6 * 10**18, 10**6, 5 * 10**18 + 1
    got = spark.range(1).select(divergence.share(*[divergence.F.lit(x) for x in (count, n, v)])).first()[0]
    assert got == 1 + 10**9 * (count + 1) // (n + v)
