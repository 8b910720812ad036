"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Component of every node of ``links`` (long columns ``a`` and ``b``): node, component.

    The component is its smallest node.  Each step is a grouped minimum with map-side
    combining and an equi-join back that adaptive execution can split at a hot node; no
    step gathers the neighbours of a node.  Every round is written to the shared folder.
    Self-links and nulls are ignored; no links give no rows.
    """
    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = _digest(edges)
    while True:
        edges = stored(_small_star(stored(_large_star(edges), "large-star")), "small-star")
        after = _digest(edges)
        if after == before:
            break
        before = after
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("digest")
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where("b > a")
    return (
        larger.join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rewired = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (
        rewired.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
    )
