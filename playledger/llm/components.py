"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    """One row that changes if the edges do."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links`` (``a, b``, long): the least id that can be reached.

    Each round hangs the neighbours of a node on the least of them, first the greater ones, then the smaller
    ones, until all components are stars; the number of rounds grows with the logarithm of the longest path. Each round is written to the shared folder.
    A node with very many links is one row per task after partial aggregation, and its join is split where skewed.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(least.select("u", "m")).distinct(), "small_star")
        now = _signature(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
