"""Exact duplicates by a persistent index of digests.

The index is a table in the shared folder, bucketed and sorted by digest. New documents are reduced
to one row per digest, and an anti-join by sort-merge against the index finds the digests not seen
before; only the new side is shuffled. These are appended with the id that stays.
A document stays if the index names its own id for its digest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.llm.common import free_name, stored
from playledger.sources.scratch import shared_folder


def digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8 as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class DigestIndex:
    """Digests seen so far and, for each, the id that stays.

    ``path``: the folder of the index; a folder that holds an index is opened with the same ``buckets``.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int) -> None:
        self.spark = spark
        self.path = path
        self.buckets = buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest the index lacks."""
        return groups.join(self.rows().hint("merge"), "digest", "left_anti")

    def add(self, groups: DataFrame) -> None:
        """Appends the unseen digests. Adding the same groups again changes nothing."""
        (
            self.unseen(groups)
            .select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.insertInto(self.table)
        )


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index. ``buckets``: by default, as many as the session has shuffle partitions."""
    return DigestIndex(
        spark,
        shared_folder(spark, "digests"),
        buckets or int(spark.conf.get("spark.sql.shuffle.partitions")),
    )


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The digests of ``docs`` are added to ``index``. ``keep_id`` is the id that stays for the text: of an
    earlier batch, or else the largest id of this one. ``group_size`` counts the equal texts in ``docs``.

    Null and empty texts are one group. Rows that repeat a ``doc_id`` count each and share its
    verdict. A group that has only null ids keeps them all. Other columns are ignored.

    The one group that holds most rows is a single row before the first shuffle, and the join back is a plain
    equi-join of shuffled sides, which adaptive execution splits where a digest is hot.
    """
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))
    groups = stored(
        hashed.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups"
    )
    index.add(groups.select("digest", "keep_id"))
    verdicts = stored(groups.select("digest", "group_size").join(index.rows().hint("merge"), "digest"), "verdicts")
    return hashed.join(verdicts, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def unique_documents(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A text whose ids are all null keeps each of its rows, as in ``deduplicate``. Rows that repeat
    id and text all stay, as no column tells them apart.

    The join is by digest and id together, so that copies of one text spread over all tasks.
    """
    key, keep = free_name(docs, "digest"), free_name(docs, "keep_id")
    hashed = docs.withColumn(key, digest(F.col("text")))
    groups = stored(
        hashed.groupBy(F.col(key).alias("digest")).agg(F.max(F.col("doc_id").cast("long")).alias("keep_id")), "groups"
    )
    index.add(groups)
    stays = groups.select("digest").join(index.rows().hint("merge"), "digest").toDF(key, keep)
    return (
        hashed.join(
            stays,
            (hashed[key] == stays[key]) & hashed["doc_id"].cast("long").eqNullSafe(stays[keep]),
            "left_semi",
        )
        .select(*[hashed[c] for c in docs.columns])
    )
