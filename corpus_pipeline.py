"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written to the shared folder as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.llm import exact_dedup, langid, packing, setsketch, suffixes
from playledger.llm.common import documents, free_name, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def row_key() -> Column:
    """A key of a row's own, from its id and text, as ids may be null or stand in several rows: even with an id, odd without.

    Rows that repeat id and text share it; no stage tells them apart. It is the same wherever it is computed, so nothing
    is written for it.
    """
    doc_id = F.col("doc_id").cast("long")
    return F.shiftleft(F.xxhash64(doc_id, F.col("text")), 1).bitwiseOR(doc_id.isNull().cast("long"))


def _without(docs: DataFrame, rows: DataFrame, key: str, purpose: str) -> DataFrame:
    """``docs`` without the rows whose key is listed. The list is written first: Spark then knows its size, and if it is
    small the texts stay where they are."""
    rows = stored(rows.distinct(), purpose)
    own = free_name(docs.join(rows.limit(0)), "row_key")
    return docs.withColumn(own, row_key()).join(rows, F.col(own) == rows[key], "left_anti").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; so do those of which no language has at least half the probability.

    The model learns from the labelled documents of the input.
    """
    key = free_name(docs, "langid_row")
    found = langid.identify(docs.select(row_key().alias("doc_id"), "text"), langid.fit_model(langid.training_rows(docs, F.lit(False))))
    bad = found.where((F.col("lang_pred") == langid.UNKNOWN) | (F.col("score") < 0.5)).select(F.col("doc_id").alias(key))
    return _without(docs, bad, key, "language_rejected")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.unique_documents(docs, exact_dedup.new_index(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more), the document with the least id stays.

    Of several rows with that id one stays. A row without an id goes if its set equals that of one with an id.
    """
    key = free_name(docs, "near_row")
    keyed = docs.select(row_key().alias("doc_id"), "text")
    found = setsketch.near_duplicates(
        keyed, setsketch.Near(num=80, den=100, shingle=5, bands=36), F.col("doc_id").bitwiseAND(F.lit(1)) == 0
    )
    found = stored(found.where("component_id IS NOT NULL").select(F.col("doc_id").alias("row"), "component_id"), "near_found")
    several = found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    members = stored(found.join(several, "component_id").distinct(), "near_members")
    ids = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("id")).where("id IS NOT NULL").distinct()
    least = members.join(ids, "row").groupBy("component_id").agg(F.min(F.struct("id", "row")).alias("least"))
    least = stored(least.select("component_id", F.col("least.row").alias("stays")), "near_least")
    dropped = members.join(least, "component_id").where("row <> stays").select(F.col("row").alias(key))
    return _without(docs, dropped, key, "near_dropped")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has, too, are cut."""
    return suffixes.without_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("passages", passages),
    ("packing", pack),
]

#: A trained model, sketches and tokens are not expressed in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
