"""Cluster-to-class mapping.

The contingency table (clusters x classes) is an aggregate; the optimal
one-to-one assignment runs on that table only (bounded by k x classes, never
by rows), grouped by run so many runs are solved in parallel.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNMAPPED = -1  # fixed value: prediction for a cluster never seen in fitting
BRUTE_FORCE_LIMIT = 200_000  # assignments enumerated exactly up to this many; Hungarian beyond


def contingency(df: DataFrame, groups: Sequence[str], cluster: str, label: str) -> DataFrame:
    """K7: (group..., cluster, label, n)."""
    return df.groupBy(*groups, F.col(cluster).alias("cluster"), F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"))


def _hungarian(w: np.ndarray) -> list[tuple[int, int]]:
    """Maximum-weight matching on a rectangular matrix (rows <= cols), O(n^2 m)."""
    n, m = w.shape
    cost = w.max() - w if w.size else w
    u = np.zeros(n + 1)
    v = np.zeros(m + 1)
    p = np.zeros(m + 1, dtype=int)
    way = np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        p[0] = i
        j0 = 0
        minv = np.full(m + 1, np.inf)
        used = np.zeros(m + 1, dtype=bool)
        while True:
            used[j0] = True
            i0 = p[j0]
            delta, j1 = np.inf, 0
            for j in range(1, m + 1):
                if not used[j]:
                    cur = cost[i0 - 1, j - 1] - u[i0] - v[j]
                    if cur < minv[j]:
                        minv[j], way[j] = cur, j0
                    if minv[j] < delta:
                        delta, j1 = minv[j], j
            for j in range(m + 1):
                if used[j]:
                    u[p[j]] += delta
                    v[j] -= delta
                else:
                    minv[j] -= delta
            j0 = j1
            if p[j0] == 0:
                break
        while True:
            j1 = way[j0]
            p[j0] = p[j1]
            j0 = j1
            if j0 == 0:
                break
    return [(p[j] - 1, j - 1) for j in range(1, m + 1) if p[j] != 0]


def assign(table: pd.DataFrame) -> pd.DataFrame:
    """Optimal one-to-one cluster -> class map on one contingency table; leftovers -> majority class.

    Ties between optimal assignments go to the lexicographically smallest
    (in class order) tuple of clusters, so the result is deterministic.
    """
    clusters = sorted(table["cluster"].unique())
    classes = sorted(table["label"].unique())
    mat = np.zeros((len(clusters), len(classes)))
    ci = {c: i for i, c in enumerate(clusters)}
    li = {c: i for i, c in enumerate(classes)}
    for r in table.itertuples(index=False):
        mat[ci[r.cluster], li[r.label]] += r.n
    mapping: dict = {}
    k, c = len(clusters), len(classes)
    if k >= c:
        n_perm = np.prod(range(k - c + 1, k + 1), dtype=float)
        if n_perm <= BRUTE_FORCE_LIMIT:
            best, best_t = None, -1.0
            for perm in itertools.permutations(range(k), c):  # perm[j] = cluster for class j
                t = sum(mat[perm[j], j] for j in range(c))
                if t > best_t:
                    best, best_t = perm, t
            mapping = {clusters[best[j]]: classes[j] for j in range(c)}
        else:
            mapping = {clusters[j]: classes[i] for i, j in _hungarian(mat.T)}
    else:
        n_perm = np.prod(range(c - k + 1, c + 1), dtype=float)
        if n_perm <= BRUTE_FORCE_LIMIT:
            best, best_t = None, -1.0
            for perm in itertools.permutations(range(c), k):  # perm[i] = class for cluster i
                t = sum(mat[i, perm[i]] for i in range(k))
                if t > best_t:
                    best, best_t = perm, t
            mapping = {clusters[i]: classes[best[i]] for i in range(k)}
        else:
            mapping = {clusters[i]: classes[j] for i, j in _hungarian(mat)}
    for cl in clusters:
        if cl not in mapping:
            mapping[cl] = classes[int(np.argmax(mat[ci[cl]]))]
    return pd.DataFrame({"cluster": list(mapping), "mapped": [mapping[c] for c in mapping]})


def cluster_to_class(cont: DataFrame, groups: Sequence[str]) -> DataFrame:
    """K8: per group, the cluster -> class map (one row per cluster)."""
    groups = list(groups)
    fields = [cont.schema[g] for g in groups]
    from pyspark.sql import types as T
    schema = T.StructType(fields + [T.StructField("cluster", cont.schema["cluster"].dataType),
                                    T.StructField("mapped", cont.schema["label"].dataType)])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = assign(pdf)
        for g in groups:
            out[g] = pdf[g].iloc[0]
        return out[[f.name for f in schema.fields]]
    if not groups:
        cont = cont.withColumn("_run", F.lit(0))
        schema = T.StructType([T.StructField("_run", T.IntegerType())] + list(schema.fields))
        groups_run = ["_run"]

        def run0(pdf: pd.DataFrame) -> pd.DataFrame:
            out = assign(pdf)
            out["_run"] = 0
            return out[["_run", "cluster", "mapped"]]
        return cont.groupBy("_run").applyInPandas(run0, schema).drop("_run")
    return cont.groupBy(*groups).applyInPandas(run, schema)


def apply_mapping(df: DataFrame, mapping: DataFrame, groups: Sequence[str], cluster: str,
                  out: str = "pred") -> DataFrame:
    """Cluster id -> class through a broadcast join (bounded map); unseen -> -1."""
    m = mapping.withColumnRenamed("cluster", cluster).withColumnRenamed("mapped", out)
    j = df.join(F.broadcast(m), on=[*groups, cluster], how="left")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(UNMAPPED)))


def minority_rule(df: DataFrame, groups: Sequence[str], cluster: str) -> DataFrame:
    """The least populated cluster is the attack cluster (ties -> lowest id); one cluster -> all normal."""
    sizes = df.groupBy(*groups, F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    g = sizes.groupBy(*groups).agg(F.count(F.lit(1)).alias("k"),
                                   F.min_by("cluster", F.struct("n", "cluster")).alias("minority"))
    j = df.join(F.broadcast(g), on=list(groups), how="left")
    return j.withColumn("pred", F.when((F.col("k") > 1) & (F.col(cluster) == F.col("minority")), 1).otherwise(0)) \
        .drop("k", "minority")
