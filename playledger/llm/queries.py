"""The registered queries of this subpackage, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.llm import (
    capfilters,
    context_tree,
    cotraining,
    divergence,
    exact_dedup,
    host_rules,
    langid,
    packing,
    pivotcodes,
    setsketch,
    suffixes,
    tokens,
    toxicity,
)
from playledger.llm.common import documents, embeddings, fold, labels


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 5) == 0
    found = langid.identify(docs, langid.fit_model(langid.training_rows(docs, held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(documents(spark, sf_dir))


def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 5) == 0
    model = cotraining.fit_model(docs.where(~held_out), labels(spark, sf_dir).where(~held_out))
    return cotraining.quality(docs, model).withColumn("held_out", held_out)


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(documents(spark, sf_dir), fold(F.col("doc_id"), 7) == 2)


def op5_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.digests(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 4) == 2
    known = labels(spark, sf_dir).where(~held_out)
    return toxicity.toxicity(docs, toxicity.fit_model(docs, known), held_out)


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(documents(spark, sf_dir), exact_dedup.new_index(spark))


def op9_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_vectors(embeddings(spark, sf_dir))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_pivot_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotcodes.compress(embeddings(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_setsketch": op2_setsketch,
    "op3_cotraining": op3_cotraining,
    "op4_context_tree": op4_context_tree,
    "op5_bpe_transducer": op5_bpe_transducer,
    "op6_toxicity": op6_toxicity,
    "op7_host_rules": op7_host_rules,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_sparse_suffixes": op9_sparse_suffixes,
    "op10_packing": op10_packing,
    "op11_cap_filters": op11_cap_filters,
    "op12_source_divergence": op12_source_divergence,
    "op13_pivot_codes": op13_pivot_codes,
}
