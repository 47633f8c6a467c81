"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest neighbour."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", "m").toDF("a", "b")).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is linked to one smaller node only, which itself is linked to none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"), (F.col("a") < F.col("b")).alias("turned"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1), F.lit(False)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"), F.max("turned").alias("turned"))
    return nodes.where("up > 1 OR up = 1 AND down = 1 OR turned").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b``): the smallest node that it reaches.

    Ends when all edges are stars. Nodes without an edge to another node do not occur. Any type with an order will do.
    """
    edges = cut_lineage(edges.where("a != b").select("a", "b").distinct(), "edges")
    while not _all_stars(edges):
        edges = cut_lineage(_small_star(_large_star(edges)), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
