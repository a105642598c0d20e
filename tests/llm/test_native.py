"""Exact duplicates and host rules: SQL, plans, edge cases."""

from collections import Counter, defaultdict

import pytest

import __spark_entry__ as repo
from playledger.llm import oracle, queries
from playledger.llm.exact_dedup import deduplicate, new_index, unique_documents
from playledger.llm.host_rules import MEASURES, Limits, judge
from tests.llm.conftest import SCHEMA
from tests.util import plan
from tools.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle.ORACLE))
def test_query_matches_its_sql(spark, name):
    wanted = connect(SF_DIR).sql(oracle.ORACLE[name])
    assert differences(queries.QUERIES[name](spark, SF_DIR), wanted) == []


def test_all_operators_are_registered():
    names = {n.split("_")[0] for n in repo.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in repo.queries()


def test_exact_dedup_edges(spark, edges, nothing):
    rows = deduplicate(edges, new_index(spark, 4)).collect()
    assert len(rows) == edges.count()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.keep_id, r.group_size, r.kept))
    assert by[1] == {(2, 3, False)} and by[2] == {(2, 3, True)}
    assert by[4] == {(10, 2, False)} and by[5] == {(7, 5, False)} and by[7] == {(7, 5, True)}
    assert by[None] == {(7, 5, False), (2, 3, False)}
    assert deduplicate(nothing, new_index(spark, 4)).count() == 0


def test_unique_documents_keep_columns(spark, edges, nothing):
    kept = unique_documents(edges, new_index(spark, 4))
    assert kept.schema == edges.schema
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 6, 7, 8, 9, 10]
    assert unique_documents(nothing, new_index(spark, 4)).count() == 0


def test_index_spans_batches_and_replays(spark):
    def docs(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, text string")

    index = new_index(spark, 4)
    assert unique_documents(docs((1, "a"), (2, "a"), (3, "b")), index).count() == 2
    second = docs((10, "a"), (11, "c"), (12, "c"))
    for _ in range(2):  # a replay changes nothing
        assert [tuple(r) for r in unique_documents(second, index).collect()] == [(12, "c")]
    assert index.rows().count() == 3
    reopened = type(index)(spark, index.path, 4)
    assert reopened.rows().count() == 3
    text = plan(reopened.unseen(second.selectExpr("unhex(sha2(text, 256)) AS digest", "doc_id AS keep_id")))
    index_side = text[text.index("FileScan") :]
    assert "SortMergeJoin" in text and "Bucketed: true" in index_side and "Exchange" not in index_side


def test_measures_against_plain_python(spark):
    texts = [
        "a b c d e a b c d e", "a b c d e f\nx\na b c d e f\n x\n\n x", "# * $ % & | < > ##", "a a a a a a a", None, "é ß 漢字 x y",
        " ".join("pqrstuvw"[i % 8] for i in range(200)) + " end",
    ]
    df = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    found = {r.doc_id: tuple(r[m] for m in MEASURES) for r in judge(df).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        words = text.encode().split()
        at = defaultdict(list)
        for k in range(len(words) - 4):
            at[tuple(words[k : k + 5])].append(k)
        covered = {k + d for v in at.values() if len(v) > 1 for k in v for d in range(5)}
        lines = [line for line in text.split("\n") if line.encode().split()]
        assert found[i] == (
            len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered),
        )


def test_host_verdicts(spark):
    good, symbols = " ".join(f"word{i}" for i in range(20)), " ".join(f"w#{i}#" for i in range(20))
    rows = [(i, symbols if i % 10 < 9 else good, "bad") for i in range(200)]
    rows += [(200 + i, symbols if i % 10 < 6 else good, "mixed") for i in range(200)]
    rows += [(400 + i, symbols if i == 0 else good, "fine") for i in range(200)]
    rows += [(600, symbols, "tiny"), (601, symbols, None), (602, "few", "fine")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in judge(df, Limits()).collect()}
    assert not any(kept[i] for i in range(200))
    assert Counter(kept[i] for i in range(200, 400)) == {True: 80, False: 120}
    assert all(kept[i] for i in range(400, 600)) and kept[601] and not kept[602]


def test_host_rule_edges(spark, edges, nothing):
    rows = judge(edges).collect()
    assert len(rows) == edges.count() and all(r.base_failed or r.kept is not None for r in rows)
    assert {r.n_words for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert judge(nothing).count() == 0
    assert judge(spark.createDataFrame([(1, "x " * 20, None)], "doc_id long, text string, source string")).count() == 1


def test_native_operators_use_no_python(spark, edges):
    for df in (judge(edges), deduplicate(edges, new_index(spark, 4)), unique_documents(edges, new_index(spark, 4))):
        assert not any(w in plan(df) for w in ("Python", "Arrow", "Pandas"))
    assert SCHEMA
