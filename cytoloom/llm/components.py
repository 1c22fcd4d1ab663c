"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoloom.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its other smaller neighbours are tied to its smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hops = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hops.union(least.select("u", F.col("m").alias("v")))


def _is_star(edges: DataFrame) -> bool:
    """Whether every node has one edge to a root that has none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)`` but the roots themselves.

    The root is the smallest node of the component. Every round is stored, so a lost
    executor costs one round at most; the number of rounds is logarithmic in practice.
    The groups of a round are pre-aggregated minima, and its joins are plain equi-joins that
    adaptive execution can split, so a node with very many links is no single task.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    edges = stored(edges.distinct(), "links")
    while not _is_star(edges):
        edges = stored(_small_star(_large_star(edges)).where("u <> v").distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
