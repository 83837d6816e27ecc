"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation (partial minimum per node, so a hub with very
many neighbours costs one row per task) and a join that AQE can split; each
round is one job that writes the edges to the shared folder and measures them
on the way.  Rounds grow with the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), both directions present for the large star, u > v for the small star."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = edges.join(least, "u")
    if large:
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node it reaches."""
    now, before = _written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") > F.col("v")).distinct())
    while before["rows"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, True).where(F.col("u") > F.col("v"))
        following, mark = _written(_star(large, False).where(F.col("u") > F.col("v")).distinct())
        common.remove(now)
        now, before, same = following, mark, mark == before
        if same:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _written(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a table, their number and the sum of their hashes: equal only when a round changed nothing."""
    return common.cut_measured(edges, "edges", hashes=F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0)))
