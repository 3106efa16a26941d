"""Distributed union-find: connected components by alternating large-star and
small-star steps over an edge table.

Each step is one partial aggregate (the smallest neighbour of a node) and one
join; the edge table shrinks towards one star per component. Nothing is
collected. Edges are stored between rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(pairs: DataFrame, keep_self: bool) -> DataFrame:
    """For every node u of pairs (u, v): link its v's to m = min(u, all v)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = pairs.join(least, "u")
    if not keep_self:                                    # large star: only larger neighbours move
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    own = least.where("u != m").select("u", F.col("m").alias("v"))
    moved = linked.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(own).distinct()


def _is_forest(edges: DataFrame) -> bool:
    """Every node points to one root at most, and roots point nowhere."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out + into > 1").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest
    node reachable. Self loops, repeated and null edges are ignored."""
    cur = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    cur = stored(cur, "edges")
    while not _is_forest(cur):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        cur = stored(_star(_star(both, keep_self=False), keep_self=True), "edges")
    roots = cur.select(F.col("v").alias("node")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
