"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, component)` for edges `(a, b)`: the least node of each
    component, by alternating large-star and small-star steps until every node
    is the end of one edge or the least of its neighbours. Every round is written
    to the shared folder; the driver sees a count a round. The first one reads
    ``edges`` as it is, more than once: give a stored table."""
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        # large star: every greater neighbour of a node points to the least of all
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: every lesser neighbour, and the node, point to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).where("a != b")
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges = stored(small, "edges")
        if _are_stars(edges):
            break
    parts = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return parts.union(edges.select("b", "b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node has two lesser neighbours, or lesser and greater ones."""
    up, down = F.lit(1), F.lit(0)
    ends = edges.select(F.col("a").alias("node"), up.alias("lesser"), down.alias("greater")).union(edges.select("b", down, up))
    nodes = ends.groupBy("node").agg(F.sum("lesser").alias("lesser"), F.sum("greater").alias("greater"))
    return nodes.where("lesser > 1 or (lesser > 0 and greater > 0)").count() == 0
