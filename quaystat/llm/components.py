"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystat.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return linked.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the least node of its component, the root itself included.

    Each round is written to the shared folder; rounds grow with the logarithm
    of the longest chain. An edge from a node to itself only lists the node.
    """
    edges = cut(edges.select("u", "v").distinct(), "edges")
    nodes = edges.select(F.col("u").alias("node")).unionAll(edges.select(F.col("v").alias("node"))).distinct()
    linked = edges.where("u != v")
    before = None
    while True:
        linked = cut(_small_star(_large_star(linked)), "stars")
        state = linked.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = linked.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
