"""Connected components of an edge table by alternating large and small stars.

Each step only groups by a node's minimum neighbour and joins that back, so a node
with very many neighbours is one partial aggregate plus rows the skew join can
split.  Every step is a written table; nothing is collected but one comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link greater neighbours to the least one; small star: all others."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sides = both if large else both.filter("b < a")
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    near = both.filter("b > a") if large else sides.filter("b < a")
    out = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    if not large:  # the node itself goes under its least neighbour too
        out = out.unionByName(least.select("a", F.col("m").alias("b")).filter("a <> b"))
    return out.distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node reachable."""
    edges = saved(edges.select("a", "b").filter("a <> b").distinct(), f"{name}-edges")
    mark = None
    for n in range(64):
        edges = saved(_star(_star(edges, True), False), f"{name}-step{n}")
        # rows and a sum of hashes stand for the set of edges
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node").unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = now
    raise RuntimeError("components: 64 rounds did not settle")
