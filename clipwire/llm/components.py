"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwire.llm.common import joined_apart, stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` for every node of ``links`` that is not itself the root.

    The root is the smallest node that can be reached. Each round links every node's larger
    neighbours, then its smaller ones, to the smallest of them, so that a component of
    any shape becomes a star in a number of rounds that grows with the logarithm of its
    size. Minima are partial aggregates and links are joined to them, split where a node
    has very many, so no node is a single task's work. Each round is written to the shared folder. Links
    with a null end and links of a node to itself are left out; no links give no rows.
    """
    edges = links.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = stored(edges.distinct(), "links")
    before = _digest(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "stars")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    """Count and sum of hashes: equal for equal sets of links."""
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where(F.col("v") > F.col("u"))
    larger = joined_apart(larger, least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = joined_apart(edges, least, "u").where(F.col("v") != F.col("m"))
    moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
