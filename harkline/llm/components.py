"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harkline.operators.frozen import freeze


def roots(parents: DataFrame) -> DataFrame:
    """``(node, root)`` of trees given as ``(node, parent)``, one parent for each node that has one.

    Each round makes everyone's grandparent their parent, so rounds grow with the logarithm of the depth.
    """
    parents, moving = freeze(parents.select("node", F.col("parent").alias("root"))), True
    while moving:
        above = parents.select(F.col("node").alias("above"), F.col("root").alias("top"))
        joined = parents.join(above, F.col("root") == F.col("above"), "left")
        parents = freeze(joined.select("node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
        moving = not parents.filter("moved").isEmpty()
        parents = parents.drop("moved")
    return parents


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``links`` (``a``, ``b``): the smallest node it is linked to, directly or not.

    Large and small stars in turn: each node ties its larger neighbours, then its smaller ones, to the smallest
    it knows, until each is tied to one that is tied to none. Rounds grow with the logarithm of the longest
    chain. A node with very many links is a sum before it is moved, and a partition that the join splits.
    """
    edges = freeze(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = freeze(large.union(least.filter("m < a").select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = freeze(small.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node is tied to two others, or to one that is tied itself."""
    tied = edges.groupBy("a").agg(F.count("*").alias("n"))
    odd = tied.filter("n > 1").select("a").union(edges.join(tied.select(F.col("a").alias("b")), "b", "left_semi").select("a"))
    return odd.isEmpty()
