"""Communication graph of Source -> Destination.

Edges are distinct pairs (an aggregate); degrees come from a union of edge
endpoints grouped by node; the node count per graph is a one-row-per-graph
table.  No graph library and no per-node Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges(df: DataFrame, groups: Sequence[str], src: str = "source", dst: str = "destination") -> DataFrame:
    """Distinct directed edges per graph (rows with a missing endpoint dropped)."""
    return (df.filter(F.col(src).isNotNull() & F.col(dst).isNotNull())
            .select(*groups, F.col(src).alias("src"), F.col(dst).alias("dst")).distinct())


def degree_centrality(e: DataFrame, groups: Sequence[str]) -> DataFrame:
    """R2: (in + out degree) / (n - 1); a self loop adds 2; one-node graphs get 1."""
    groups = list(groups)
    ends = e.select(*groups, F.col("src").alias("node"), F.lit(1).alias("d")).unionByName(
        e.select(*groups, F.col("dst").alias("node"), F.lit(1).alias("d")))
    deg = ends.groupBy(*groups, "node").agg(F.sum("d").alias("degree"))
    n = deg.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_nodes"))
    if not groups:
        deg, n, groups = deg.withColumn("_g", F.lit(0)), n.withColumn("_g", F.lit(0)), ["_g"]
    # one row per graph: a bounded broadcast
    j = deg.join(F.broadcast(n), on=groups, how="inner")
    cent = F.when(F.col("n_nodes") <= 1, F.lit(1.0)).otherwise(F.col("degree") / (F.col("n_nodes") - 1))
    return j.select(*groups, "node", "degree", cent.alias("centrality"))


def centrality_change(cent: DataFrame, label: str = "attack") -> DataFrame:
    """Normal vs attack centrality per node, full outer join, missing -> 0, change = attack - normal."""
    a = cent.filter(F.col(label) == 1).select("node", F.col("centrality").alias("attack_centrality"))
    b = cent.filter(F.col(label) == 0).select("node", F.col("centrality").alias("normal_centrality"))
    j = b.join(a, on="node", how="full").fillna(0.0, subset=["attack_centrality", "normal_centrality"])
    return j.withColumn("centrality_change", F.col("attack_centrality") - F.col("normal_centrality"))
