"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import join_hot, saved


def _is_stars(edges: DataFrame) -> bool:
    """Does every edge lead from a node with no other edge to one that leads nowhere?"""
    if not edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
        return False
    return edges.groupBy("a").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of longs -> (a, b): every node that is not the least of its component, with that least node.

    One round joins, for each node, its larger neighbours to its least neighbour, then its smaller ones; rounds grow
    with the logarithm of the graph. Minima are aggregated before the join, and a hub's minimum goes to where its edges are.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = saved(edges, "edges")
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
        large = join_hot(both, least, "a", "n").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.distinct(), "larger")
        least = saved(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least")
        small = join_hot(large, least, "a", "n").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(least.select("a", F.col("m").alias("b")).unionByName(small).distinct(), "edges")
    return edges
