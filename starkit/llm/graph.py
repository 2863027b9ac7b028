"""Connected components of verified links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least node among its neighbours and itself."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none: told in one shuffle, without a further step."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("root"))
    )
    each = ends.groupBy("node").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.bool_or(F.col("root").isNull()).alias("is_root"))
    return not each.agg(F.count_if((F.col("least") < F.col("most")) | (F.col("is_root") & F.col("least").isNotNull()))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """For each node of ``edges`` (a, b: long, different) that is not the least of its component: node, root.

    Two shuffles a step on rows of two numbers; each step is written, so that a lost executor costs one step.
    The number of steps grows with the logarithm of the size of the largest component.
    """
    edges = stage(_small_star(edges.select("a", "b").distinct()).distinct(), "stars")
    while not _settled(edges):
        edges = stage(_small_star(_large_star(edges).distinct()).distinct(), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
