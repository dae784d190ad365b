"""Connected components by alternating large-star and small-star (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored

#: The minima of up to so many links are broadcast to them (two numbers each); more are joined by Spark's choice.
SENT_LINKS = 200_000


def large_star(edges: DataFrame, few: bool = False) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours; links may repeat.

    Neighbourhoods are never gathered: their minimum is a combined aggregate that is joined back to the links.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    linked = both.where("b > a").join(F.broadcast(least) if few else least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame, few: bool = False) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(F.broadcast(least) if few else least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has either one smaller neighbour or none: each link then leads to a root."""
    up = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = up.union(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max((F.col("up") + F.col("down")) > 1).alias("open")).first().open


def forest(edges: DataFrame) -> DataFrame:
    """Links ``a, b`` of every node to the smallest node of its component (roots have none), from links ``a, b`` (longs).

    Each round is written to the shared folder; the driver sees one flag of it. Links that are settled already, as
    those of an earlier forest are, take no round. Links to oneself and repeats do no harm.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    few = edges.count() <= SENT_LINKS  # no round makes more links than it gets
    while not _settled(edges):
        edges = stored(small_star(large_star(edges, few), few))
    return edges
