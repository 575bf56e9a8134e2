"""Connected components by alternating stars, every step a grouped minimum and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.session import materialize


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other and none of those hangs on another: nothing is left
    to do, and another round would only repeat the links."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1))).groupBy("v").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return ends.filter("up > 1 OR (up > 0 AND down > 0)").limit(1).count() == 0


def _least(pairs: DataFrame) -> DataFrame:
    """Per ``a`` the least of itself and its ``b``. Written, so that the join against it is a join
    of two shuffles, whose hot keys adaptive execution can split."""
    return materialize(pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) to (node, component): the least node that can be reached.

    Large star: every node hangs its larger neighbours on its least one. Small star: every node
    hangs itself and its smaller neighbours on the least of them. The links shrink to stars
    around the least nodes in about log(n) rounds; a node with a third of all links is summed
    map-side and its join is split. Nodes without a link are not listed.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.filter("b > a").join(_least(both), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "large_star")
        least = _least(large)
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small_star")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select("b", "b").distinct())
