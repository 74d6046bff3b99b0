"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(a, b)``: label is the smallest
    node of its component.

    Large star: every node hands its smallest neighbour (or itself) to its larger
    neighbours; small star: the same among smaller ones.  Both keep components
    and end, after about log(nodes) rounds, in one star around each smallest
    node.  Each round is written to the shared folder; none is run to see that
    the stars stay as they are.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    while not are_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # after the large star every edge points from the larger to the smaller node
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "stars")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def are_stars(edges: DataFrame) -> bool:
    """Whether ``edges(u, v)``, u > v without repeats, are stars around their smallest
    nodes: each u has one edge and is the v of none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not ends.agg(F.max((F.col("out") + F.col("into") > 1) & (F.col("out") > 0))).first()[0]
