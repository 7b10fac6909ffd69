"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, reread


def _flipped(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("b").alias("a"), F.col("a").alias("b"))


def _stars(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    """One large-star and one small-star step; edges (a, b) with a < b in and out, and the tables that the result reads.

    Large star: every node hands its larger neighbours to its smallest neighbour (or itself). Small star: every
    node hands its smaller neighbours and itself to the smallest of them. Both keep components and pull
    every node towards the smallest of its component; a node's neighbours are only aggregated by min. The minima
    are written, so the joins are plain ones and adaptive execution can split the many edges of one node.
    """
    both = edges.select("a", "b").unionByName(_flipped(edges))
    least, least_path = reread(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    large, large_path = reread(large, "large-star")
    below, below_path = reread(large.groupBy("a").agg(F.min("b").alias("m")), "below")
    handed = large.join(below, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    small = below.select("a", F.col("m").alias("b")).unionByName(handed).distinct()
    return _flipped(small), [least_path, large_path, below_path]


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every larger end has one edge and is no smaller end of another."""
    ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")).unionByName(edges.select(F.col("a").alias("node"), F.lit(0).alias("above"), F.lit(1).alias("below")))
    return ends.groupBy("node").agg(F.sum("above").alias("above"), F.max("below").alias("below")).filter("above > 1 or (above = 1 and below = 1)").isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    edges: columns a and b, of one orderable type without nulls. Every round is written to the shared folder; the rounds
    end when the edges are stars around the smallest nodes.
    """
    spark = edges.sparkSession
    current, path = reread(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        if _settled(current):
            break
        step, parts = _stars(current)
        current, new_path = reread(step, "edges")
        for old in (path, *parts):
            drop_table(spark, old)
        path = new_path
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    nodes = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.unionByName(current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
