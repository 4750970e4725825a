"""Connected components by alternating large-star and small-star over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    least = materialise(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one link at most, to a node without one: then every component is a star."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) of each node that a link touches: root is the least node of its component.

    ``edges`` has two long columns a and b; links to itself and repeated ones do not matter. Hot nodes are
    summed up in each task before they move, and the tables joined are stored, so that a join
    on a hot node can be split.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = materialise(edges.where("a != b").select(larger, smaller).distinct(), "edges")
    while not _settled(edges):
        edges = materialise(_small_star(materialise(_large_star(edges), "large-star")), "small-star")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
