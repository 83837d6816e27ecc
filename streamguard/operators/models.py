"""Model-backed operators on Spark ML.

Feature matrices are fitted on the training split with ``stats.prepare``
(prune, median fill, variance filter, z-score) and assembled into vectors;
models are ``pyspark.ml`` estimators, so fitting and scoring are distributed.
Only model parameters (components, centroids, trees) reach the driver, and
each is bounded by features x components, never by rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans, KMeansModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import exact_quantiles
from ..session import cut_lineage, side_by_side
from . import stats as ST
from . import stream
from .detect import top_share

SEED = 42  # fixed values of the reference's model settings
IFOREST_TREES = 100
IFOREST_SAMPLE = 256
RF_TREES = 200
RF_MAX_DEPTH = 30  # Spark's limit; the trees are otherwise grown without one
LATENT_DIM = 16
UCAD_CONTAMINATION = 0.076
SEQ_LEN = 30


class Matrix:
    """A fitted preparation: kept features, medians and moments; applies to any frame."""

    def __init__(self, train: DataFrame, features: Sequence[str], strict: bool = False,
                 always_keep: Sequence[str] = (), zero_fill: bool = False):
        self.zero_fill = zero_fill
        if zero_fill:
            filled = train.select(*[F.coalesce(ST.dbl(c), F.lit(0.0)).alias(c) for c in features])
            self.kept, self.medians, self.mom = list(features), {c: 0.0 for c in features}, ST.moments(filled, features)
        else:
            self.kept, self.medians, self.mom = ST.prepare(train, features, strict=strict, always_keep=always_keep)

    def z(self, df: DataFrame) -> DataFrame:
        return ST.clean_matrix(df, self.kept, self.medians, self.mom)

    def vectors(self, df: DataFrame, out: str = "features") -> DataFrame:
        """M9: the standardized kept columns as one vector column."""
        return VectorAssembler(inputCols=self.kept, outputCol=out, handleInvalid="keep").transform(self.z(df))


# ------------------------------------------------------------------ D: dimensionality


def pca_importance(train: DataFrame, features: Sequence[str], k: int = 10) -> DataFrame:
    """|PC1 loading| per feature of the standardized training matrix, with its variance."""
    mx = Matrix(train, features)
    k = max(1, min(k, len(mx.kept)))
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(mx.vectors(train))
    pc1 = np.abs(model.pc.toArray()[:, 0])
    spark = train.sparkSession
    imp = spark.createDataFrame([(f, float(v)) for f, v in zip(mx.kept, pc1)], "feature string, pca_importance double")
    var = ST.variance_rank(ST.impute(train, mx.medians, mx.kept), mx.kept)
    return var.join(imp, on="feature", how="inner")


def select_by_importance(importance: DataFrame, features: Sequence[str], threshold: float = 0.0) -> list[str]:
    """M8: features whose PCA importance reaches the threshold, in the given order; none -> all."""
    keep = {r["feature"] for r in importance.filter(F.col("pca_importance") >= threshold).select("feature").collect()}
    picked = [f for f in features if f in keep]
    return picked or list(features)


def pca_project(df: DataFrame, features: Sequence[str], group: str = "attack_type", id_col: str = "packet_id",
                k: int = 2) -> DataFrame:
    """First ``k`` principal coordinates per group (null -> 0), with the explained variance ratios."""
    outs = []
    for g in [r[0] for r in df.select(group).distinct().collect()]:  # one distributed fit per group
        sub = df.filter(F.col(group) == g)
        filled = sub.select(id_col, group, *[F.coalesce(ST.dbl(c), F.lit(0.0)).alias(c) for c in features])
        mom = ST.moments(filled, features)
        kept = [c for c in features if mom[c][1] and mom[c][1] > 1e-12 * max(1.0, abs(mom[c][0] or 0.0))]
        z = ST.standardize(filled.select(id_col, group, *kept), mom, kept)
        v = VectorAssembler(inputCols=kept, outputCol="features").transform(z)
        model = PCA(k=min(k, len(kept)), inputCol="features", outputCol="pc").fit(v)
        ev = [float(x) for x in model.explainedVariance.toArray()]
        p = model.transform(v).select(id_col, group, vector_to_array("pc").alias("pc"))
        outs.append(p.select(id_col, group, *[F.col("pc")[i].alias(f"pc{i + 1}") for i in range(len(ev))],
                             *[F.lit(e).alias(f"explained_{i + 1}") for i, e in enumerate(ev)]))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o, allowMissingColumns=True)
    return out


def rf_importance(train: DataFrame, features: Sequence[str], label: str = "attack") -> DataFrame:
    """D3: random-forest (200 trees, seed 42) Gini importances on the prepared training matrix."""
    mx = Matrix(train, features)
    data = mx.vectors(train).withColumn("_label", F.col(label).cast("double"))
    rf = RandomForestClassifier(numTrees=RF_TREES, maxDepth=RF_MAX_DEPTH, seed=SEED, labelCol="_label",
                                featuresCol="features")
    imp = rf.fit(data).featureImportances.toArray()
    return train.sparkSession.createDataFrame([(f, float(v)) for f, v in zip(mx.kept, imp)],
                                              "feature string, importance double")


def linear_map(cols: Sequence[Column], weights: np.ndarray) -> list[Column]:
    """y_j = sum_i w[i, j] * x_i as JVM expressions (weights bounded by features x components)."""
    out = []
    for j in range(weights.shape[1]):
        e = F.lit(0.0)
        for i, c in enumerate(cols):
            e = e + c * F.lit(float(weights[i, j]))
        out.append(e)
    return out


def latent_model(train: DataFrame, features: Sequence[str], k: int = LATENT_DIM,
                 id_cols: Sequence[str] = ("packet_id",)) -> tuple[Callable[[DataFrame], DataFrame], list[str]]:
    """D4 fitted once on ``train``: the result adds latent codes and the reconstruction error mean((x - x_hat)^2)."""
    mx = Matrix(train, features, zero_fill=True)
    k = min(k, len(mx.kept))
    pc = PCA(k=k, inputCol="features", outputCol="pc").fit(mx.vectors(train)).pc.toArray()
    codes = [f"z{j}" for j in range(k)]

    back = pc @ pc.T
    width = len(mx.kept)

    @F.pandas_udf("array<double>")
    def latent(values: pd.Series) -> pd.Series:
        x = np.stack(values.to_numpy()) if len(values) else np.zeros((0, width))
        z, rec, err = np.zeros((len(x), k)), np.zeros((len(x), width)), np.zeros(len(x))
        for i in range(width):  # sums in feature order
            z += x[:, i:i + 1] * pc[i]
            rec += x[:, i:i + 1] * back[i]
        for i in range(width):
            err += (x[:, i] - rec[:, i]) ** 2
        return pd.Series(list(np.concatenate([z, err[:, None] / width], axis=1)))
    # a filter on its results stays above it: below, the optimizer would write the filter out in every
    # mixture of a feature's name and its expression, 2 ** features of them
    latent = latent.asNondeterministic()

    def apply(df: DataFrame) -> DataFrame:
        z = mx.z(df)
        # a product in the task: as expressions, its features x features terms are written out in every plan
        z = z.select(*id_cols, *[F.col(c) for c in z.columns if c not in id_cols], latent(F.array(*mx.kept)).alias("_latent"))
        return z.select("*", *[F.col("_latent")[j].alias(n) for j, n in enumerate(codes)], F.col("_latent")[k].alias("recon_error")).drop("_latent")
    return apply, codes


def pca_latent(train: DataFrame, df: DataFrame, features: Sequence[str], k: int = LATENT_DIM,
               id_cols: Sequence[str] = ("packet_id",)) -> tuple[DataFrame, list[str]]:
    """Latent code (k principal coordinates) and reconstruction error of every row of ``df``."""
    apply, codes = latent_model(train, features, k, id_cols)
    return apply(df), codes


# ------------------------------------------------------------------ B: binary detectors


STARTS_AT_ONCE = 3  # seeds whose first centres are drawn side by side
BLOCK_ROWS = 4096  # rows whose distances to the centres of all restarts are held at once


def _summed(x: DataFrame, sums: Callable) -> np.ndarray:
    """The arrays that ``sums`` makes of the rows, one per task, added up.

    Tasks are as many as the executors' cores, not as the table's partitions: what
    reaches the driver does not grow with the rows, and a step is one stage.
    """
    tasks = x.coalesce(max(1, x.sparkSession.sparkContext.defaultParallelism))
    parts = tasks.mapInArrow(sums, "g array<double>").toArrow().column("g").combine_chunks()
    return parts.flatten().to_numpy(zero_copy_only=False).reshape(len(parts), -1).sum(axis=0)


def _lloyd_sums(centers: np.ndarray, vec: str) -> Callable:
    """Partial sums of one step of several clusterings: per restart and centre the sum and number of its rows, per restart the cost."""
    r, k, d = centers.shape
    flat = centers.reshape(r * k, d)
    square = (flat * flat).sum(axis=1)

    def sums(batches):
        total, counts, cost = np.zeros((r * k, d)), np.zeros(r * k), np.zeros(r)
        for batch in batches:
            x = batch.column(vec).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for lo in range(0, len(x), BLOCK_ROWS):
                rows = x[lo:lo + BLOCK_ROWS]
                far = (rows @ (-2.0 * flat.T) + square).reshape(len(rows), r, k)
                at = far.argmin(axis=2) + np.arange(r) * k
                cost += np.maximum(far.min(axis=2) + (rows * rows).sum(axis=1)[:, None], 0.0).sum(axis=0)
                member = np.zeros((len(rows), r * k))
                member[np.arange(len(rows))[:, None], at] = 1.0
                total += member.T @ rows
                counts += member.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"g": pa.array([np.concatenate([total.ravel(), counts, cost])], pa.list_(pa.float64()))})
    return sums


def restart_costs(data: DataFrame, starts: Sequence[np.ndarray], max_iter: int, tolerance: float) -> np.ndarray:
    """Cost at which Lloyd's steps from each of ``starts`` end; a pass over the rows makes one step of all restarts still under way."""
    at, costs = [c.copy() for c in starts], np.full(len(starts), np.inf)
    x = data.select(vector_to_array("features").alias("_x"))
    groups: dict[int, list[int]] = {}  # clusterings of as many centres: one array
    for i, c in enumerate(at):
        groups.setdefault(len(c), []).append(i)
    for k, running in groups.items():
        d = at[running[0]].shape[1]
        for _ in range(max_iter):
            r = len(running)
            got = _summed(x, _lloyd_sums(np.stack([at[i] for i in running]), "_x"))  # restarts x centres x features numbers
            total, counts, cost = got[:r * k * d].reshape(r, k, d), got[r * k * d:r * k * (d + 1)].reshape(r, k), got[r * k * (d + 1):]
            still = []
            for j, i in enumerate(running):
                new = np.where(counts[j][:, None] > 0, total[j] / np.maximum(counts[j], 1.0)[:, None], at[i])
                moved = ((new - at[i]) ** 2).sum(axis=1)
                at[i], costs[i] = new, cost[j]
                if (moved > tolerance * tolerance).any():
                    still.append(i)
            running = still
            if not running:
                break
    return costs


def kmeans_restarts(train_v: DataFrame, k: int, max_iter: int, restarts: int) -> KMeansModel:
    """K-means from ``restarts`` seeds; the lowest cost (to 9 digits, then the first seed) is kept.

    Spark's estimator picks the first centres of every seed.  Their steps are made side by
    side, one pass over the rows for all seeds, and tell each seed's cost; the estimator is
    then fitted from the best one.
    """
    def estimator(seed: int, steps: int) -> KMeans:
        return KMeans(k=k, seed=seed, maxIter=steps, featuresCol="features", predictionCol="cluster")
    data = train_v.select("features").persist()
    try:
        best = SEED
        if restarts > 1:
            seeds = [SEED + i for i in range(restarts)]
            data.count()  # held once, then the seeds' small jobs share the executors
            centers = lambda s: np.stack(estimator(s, 0).fit(data).clusterCenters())
            starts = side_by_side(data.sparkSession, [lambda s=s: centers(s) for s in seeds], STARTS_AT_ONCE)
            costs = restart_costs(data, starts, max_iter, estimator(SEED, 0).getTol())
            # equal clusterings found from two seeds differ in the last bits of their cost
            best = min(zip(costs, seeds, strict=True), key=lambda c: float(f"{c[0]:.8e}"))[1]
        return estimator(best, max_iter).fit(data)
    finally:
        data.unpersist()


EPSILON = float(np.finfo(float).eps)
BLOCK_WORK = 1e9  # products of a mixture's step (rows x components x features x features) from which blocks of rows are faster than Spark's estimator


def _roots(covariances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per covariance a root of its pseudo-inverse and the log of the density's factor, as Spark's multivariate Gaussian has them."""
    roots, logs = np.zeros_like(covariances), np.zeros(len(covariances))
    for i, cov in enumerate(covariances):
        spread, axes = np.linalg.eigh(cov)
        there = spread > EPSILON * spread.max() * len(spread)
        roots[i] = np.where(there, 1.0 / np.sqrt(np.where(there, spread, 1.0)), 0.0)[:, None] * axes.T
        logs[i] = -0.5 * (len(spread) * np.log(2.0 * np.pi) + np.log(spread[there]).sum())
    return roots, logs


def _densities(rows: np.ndarray, weights: np.ndarray, means: np.ndarray, roots: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Weighted density of every component at each row, none of them 0."""
    out = np.empty((len(rows), len(weights)))
    for i, (mean, root) in enumerate(zip(means, roots, strict=True)):
        v = (rows - mean) @ root.T
        out[:, i] = EPSILON + weights[i] * np.exp(logs[i] - 0.5 * np.einsum("ij,ij->i", v, v))
    return out


def _mixture_sums(weights: np.ndarray, means: np.ndarray, covariances: np.ndarray, vec: str) -> Callable:
    """Partial sums of one expectation step: per component its weight, weighted rows and (upper half of) their products, and the log likelihood."""
    k, d = means.shape
    roots, logs = _roots(covariances)
    upper = np.triu_indices(d)

    def sums(batches):
        total, first, second, likelihood = np.zeros(k), np.zeros((k, d)), np.zeros((k, d, d)), 0.0
        for batch in batches:
            x = batch.column(vec).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for lo in range(0, len(x), BLOCK_ROWS):
                rows = x[lo:lo + BLOCK_ROWS]
                share = _densities(rows, weights, means, roots, logs)
                whole = share.sum(axis=1)
                likelihood += np.log(whole).sum()
                share /= whole[:, None]
                total += share.sum(axis=0)
                first += share.T @ rows
                for i in range(k):
                    second[i] += (rows * share[:, i:i + 1]).T @ rows
        yield pa.RecordBatch.from_pydict({"g": pa.array([np.concatenate([total, first.ravel(), second[:, upper[0], upper[1]].ravel(), [likelihood]])], pa.list_(pa.float64()))})
    return sums


def gaussian_mixture(train_v: DataFrame, k: int, max_iter: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, means and covariances of a Gaussian mixture.

    Spark's estimator draws the first components and its steps are made here, with the same
    stop: a pass over the rows takes matrix products of whole blocks, where the estimator
    adds up the products of one row at a time.  Sums differ in their last bits, so which of
    several equal components holds a row may differ too.
    """
    est = GaussianMixture(k=k, seed=SEED, maxIter=0, featuresCol="features")
    tolerance = est.getTol()
    x = train_v.select(vector_to_array("features").alias("_x")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        start = est.fit(train_v)
        found = start.gaussiansDF.collect()  # a row per component
        weights, means = np.array(start.weights), np.stack([r["mean"].toArray() for r in found])
        covariances = np.stack([r["cov"].toArray() for r in found])
        d = means.shape[1]
        upper = np.triu_indices(d)
        likelihood, before = -np.finfo(float).max, 0.0
        for _ in range(max_iter):
            if not abs(likelihood - before) > tolerance:
                break
            got = _summed(x, _mixture_sums(weights, means, covariances, "_x"))  # components x features x features numbers
            total, first, half = got[:k], got[k:k * (1 + d)].reshape(k, d), got[k * (1 + d):-1].reshape(k, -1)
            second = np.zeros((k, d, d))
            second[:, upper[0], upper[1]] = half
            second[:, upper[1], upper[0]] = half
            means = first / total[:, None]
            covariances = (second - total[:, None, None] * means[:, :, None] * means[:, None, :]) / total[:, None, None]
            weights = total / total.sum()
            before, likelihood = likelihood, got[-1]
        return weights, means, covariances
    finally:
        x.unpersist()


def mixture_assign(weights: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> Callable[[DataFrame], DataFrame]:
    """Adds ``cluster``, the likeliest component of each row, the first of equals."""
    roots, logs = _roots(covariances)
    d = means.shape[1]

    @F.pandas_udf("int")
    def likeliest(values: pd.Series) -> pd.Series:
        x = np.stack(values.to_numpy()) if len(values) else np.zeros((0, d))
        at = [np.zeros(0, np.int32)]
        for lo in range(0, len(x), BLOCK_ROWS):
            share = _densities(x[lo:lo + BLOCK_ROWS], weights, means, roots, logs)
            at.append((share / share.sum(axis=1)[:, None]).argmax(axis=1).astype(np.int32))
        return pd.Series(np.concatenate(at))
    return lambda df: df.withColumn("cluster", likeliest(vector_to_array("features")))


def cluster_model(train_v: DataFrame, kind: str, k: int, max_iter: int = 20,
                  restarts: int = 1) -> Callable[[DataFrame], DataFrame]:
    """Fit on ``train_v`` (K-means: from ``restarts`` seeds); the result adds ``cluster`` to any frame with ``features``."""
    if kind == "kmeans":
        model = kmeans_restarts(train_v, k, max_iter, restarts)
        return model.transform
    if kind == "gmm":
        row = train_v.select("features").first()
        if row is not None and train_v.count() * k * row[0].size ** 2 >= BLOCK_WORK:
            return mixture_assign(*gaussian_mixture(train_v, k, max_iter))
        est = GaussianMixture(k=k, seed=SEED, maxIter=max_iter, featuresCol="features", predictionCol="cluster", probabilityCol="_prob")
        model = est.fit(train_v)
        return lambda df: model.transform(df).drop("_prob")
    if kind == "bisecting":
        est = BisectingKMeans(k=k, seed=SEED, maxIter=max_iter, featuresCol="features", predictionCol="cluster")
        return est.fit(train_v).transform
    raise ValueError(kind)


def fit_predict_clusters(train_v: DataFrame, test_v: DataFrame, kind: str, k: int, max_iter: int = 20,
                         restarts: int = 1) -> DataFrame:
    return cluster_model(train_v, kind, k, max_iter, restarts)(test_v)


def _flat_tree(nodes: np.ndarray, rest: Callable) -> tuple:
    """(feature, split, children, path length, levels) of a tree's nodes; a leaf leads to itself.

    ``nodes`` are rows (tree, node, feature, split, left, right, size), children
    behind their parents; ``rest`` is the path length that a leaf's size stands for.
    """
    me, feat = np.arange(len(nodes)), nodes[:, 2].astype(np.intp)
    leaf = feat < 0
    left, right = np.where(leaf, me, nodes[:, 4].astype(np.intp)), np.where(leaf, me, nodes[:, 5].astype(np.intp))
    depth = np.zeros(len(nodes))
    for i in np.flatnonzero(~leaf):
        depth[left[i]] = depth[right[i]] = depth[i] + 1
    children = np.stack([right, left], axis=1).ravel()  # at 2 * node + (goes left)
    return np.where(leaf, 0, feat), np.where(leaf, -np.inf, nodes[:, 3].astype(float)), children, depth + rest(nodes[:, 6]), int(depth.max())


def _path_lengths(x: np.ndarray, trees: Sequence[tuple]) -> np.ndarray:
    """Sum over the trees of each row's path length, in blocks of rows."""
    total = np.zeros(len(x))
    for lo in range(0, len(x), BLOCK_ROWS):
        rows = np.ascontiguousarray(x[lo:lo + BLOCK_ROWS])
        flat, first = rows.ravel(), np.arange(len(rows)) * x.shape[1]
        for feat, split, children, length, levels in trees:
            node = np.zeros(len(rows), np.intp)
            for _ in range(levels):
                left = flat.take(first + feat.take(node)) < split.take(node)
                node = children.take(2 * node + left)
            total[lo:lo + BLOCK_ROWS] += length.take(node)
    return total


def isolation_forest(z_train: DataFrame, z_test: DataFrame, cols: Sequence[str], contamination: float,
                     id_col: str = "packet_id") -> tuple[DataFrame, DataFrame]:
    """B1: isolation forest (100 trees, 256-row samples); outliers (score above the train quantile) -> 1.

    Takes prepared frames and returns (id, if_score, pred) of both.

    Each tree's sample is drawn by id hash without collecting: every row joins
    the trees whose hash falls under a rate sized for about 1.3 x 256 rows, the
    256 smallest hashes per tree are kept; trees grow in parallel with
    ``groupBy(tree).applyInPandas``; scoring maps partitions with the forest
    (100 small arrays) broadcast.
    """
    cols = list(cols)
    n = z_train.count()
    rate = min(1.0, 1.3 * IFOREST_SAMPLE / max(n, 1))
    trees = F.sequence(F.lit(0), F.lit(IFOREST_TREES - 1))
    h = lambda t: (F.abs(F.xxhash64(F.col(id_col), t, F.lit(SEED))) % 1000000007) / 1000000007.0
    picked = z_train.select(id_col, *cols, F.filter(trees, lambda t: h(t) < rate).alias("_trees"))
    samp = picked.select(id_col, *cols, F.explode("_trees").alias("tree")).withColumn("_h", h(F.col("tree")))
    node_schema = T.StructType([T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
                                T.StructField("feat", T.IntegerType()), T.StructField("split", T.DoubleType()),
                                T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
                                T.StructField("size", T.IntegerType())])

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_h").head(IFOREST_SAMPLE)
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(SEED + t)
        x = pdf[cols].to_numpy(dtype=float)
        limit = int(np.ceil(np.log2(max(len(x), 2))))
        rows = []

        def build(idx, depth):
            me = len(rows)
            rows.append(None)
            xs = x[idx]
            if depth >= limit or len(idx) <= 1 or np.all(xs.max(0) == xs.min(0)):
                rows[me] = (t, me, -1, 0.0, -1, -1, len(idx))
                return me
            spread = np.where(xs.max(0) > xs.min(0))[0]
            f = int(rng.choice(spread))
            s = float(rng.uniform(xs[:, f].min(), xs[:, f].max()))
            lo, hi = idx[xs[:, f] < s], idx[xs[:, f] >= s]
            left = build(lo, depth + 1)
            right = build(hi, depth + 1)
            rows[me] = (t, me, f, s, left, right, len(idx))
            return me
        build(np.arange(len(x)), 0)
        return pd.DataFrame(rows, columns=[f.name for f in node_schema.fields])

    forest = samp.groupBy("tree").applyInPandas(grow, node_schema).toPandas()  # 100 trees x <= 511 nodes
    by_tree = {t: g.sort_values("node").to_numpy() for t, g in forest.groupby("tree")}
    spark = z_train.sparkSession
    bc = spark.sparkContext.broadcast(by_tree)
    psi = IFOREST_SAMPLE

    def c(nn):
        nn = np.asarray(nn, dtype=float)
        return np.where(nn > 2, 2 * (np.log(np.maximum(nn - 1, 1)) + 0.5772156649) - 2 * (nn - 1) / np.maximum(nn, 1),
                        np.where(nn == 2, 1.0, 0.0))

    def score(batches):
        trees = [_flat_tree(arr, c) for arr in bc.value.values()]
        for pdf in batches:
            mean_depth = _path_lengths(pdf[cols].to_numpy(dtype=float), trees) / len(trees)
            yield pd.DataFrame({id_col: pdf[id_col].to_numpy(),
                                "if_score": 2.0 ** (-mean_depth / c(min(psi, max(n, 2))))})

    out_schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("if_score", T.DoubleType())])
    tr = z_train.select(id_col, *cols).mapInPandas(score, out_schema)
    te = z_test.select(id_col, *cols).mapInPandas(score, out_schema)
    tr = cut_lineage(tr)
    thr = exact_quantiles(tr, "if_score", [], [1.0 - contamination]).collect()[0][0]
    return tuple(d.withColumn("pred", (F.col("if_score") > F.lit(thr)).cast("int")) for d in (tr, te))


def one_class_rff(z_train: DataFrame, z_test: DataFrame, cols: Sequence[str], nu: float, dim: int = 128,
                  iters: int = 40, tolerance: float = 0.02, id_col: str = "packet_id") -> tuple[DataFrame, DataFrame]:
    """B2: one-class SVM with an RBF kernel (gamma = 1 / d) approximated by random Fourier features.

    The primal objective 1/2 |w|^2 + 1/(nu n) sum max(0, rho - w.phi(x)) - rho is
    minimised by full-batch subgradient steps, until a step moves w by less
    than ``tolerance`` of its length (or ``iters`` steps).  Each step maps the
    rows with numpy (features -> phi -> margin) into one partial sum of
    ``dim`` + 1 numbers per task.  The offset
    is then the exact nu-quantile of the training scores; outliers lie below.
    Takes prepared frames and returns (id, ocsvm_score, pred) of both.
    """
    cols = list(cols)
    d = max(1, len(cols))
    rng = np.random.default_rng(SEED)
    W = rng.normal(scale=np.sqrt(2.0 / d), size=(len(cols), dim))  # gamma = 1 / d
    b = rng.uniform(0, 2 * np.pi, size=dim)
    scale = np.sqrt(2.0 / dim)
    spark = z_train.sparkSession
    bc = spark.sparkContext.broadcast((W, b, scale))
    x = z_train.select(F.array(*cols).alias("_x")).persist(StorageLevel.MEMORY_AND_DISK)  # read by every step
    try:
        n = max(1, x.count())
        w, rho = np.zeros(dim), 0.0
        for it in range(iters):
            w_b, rho_b = w.copy(), rho

            def grad(batches, w_b=w_b, rho_b=rho_b):
                W_, b_, sc = bc.value
                k, g = 0, np.zeros(dim)
                for batch in batches:
                    rows = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(W_))
                    for lo in range(0, len(rows), BLOCK_ROWS):
                        phi = np.cos(rows[lo:lo + BLOCK_ROWS] @ W_ + b_) * sc
                        viol = phi @ w_b < rho_b
                        k += int(viol.sum())
                        g += phi[viol].sum(axis=0)
                yield pa.RecordBatch.from_pydict({"g": pa.array([[*g.tolist(), float(k)]], pa.list_(pa.float64()))})
            total = _summed(x, grad)  # dim + 1 numbers
            g, k = total[:dim], total[dim]
            lr = 1.0 / (it + 1)
            step = lr * (w - g / (nu * n))
            w = w - step
            rho = rho - lr * (-1.0 + k / (nu * n))
            if it >= 10 and np.linalg.norm(step) <= tolerance * np.linalg.norm(w):
                break
    finally:
        x.unpersist()

    def score(batches, w=w):
        W_, b_, sc = bc.value
        for pdf in batches:
            s_ = (np.cos(pdf[cols].to_numpy(dtype=float) @ W_ + b_) * sc) @ w
            yield pd.DataFrame({id_col: pdf[id_col].to_numpy(), "ocsvm_score": s_})
    tr, te = (z.select(id_col, *cols).mapInPandas(score, f"{id_col} long, ocsvm_score double") for z in (z_train, z_test))
    tr = cut_lineage(tr)
    offset = exact_quantiles(tr, "ocsvm_score", [], [nu]).collect()[0][0]
    return tuple(x.withColumn("pred", (F.col("ocsvm_score") < F.lit(offset)).cast("int")) for x in (tr, te))


def reconstruction_detector(train: DataFrame, test: DataFrame, features: Sequence[str],
                            contamination: float = UCAD_CONTAMINATION, rounds: int = 2,
                            id_col: str = "packet_id") -> DataFrame:
    """Pseudo labels from reconstruction error (top share), a classifier on the latent code, relabel, refit.

    The training rows' codes and each round's labels are cut from lineage (the
    iterative loop stays short and survives executor loss), and the frames that
    ranked them are let go.
    """
    codes, zcols = latent_model(train, features)
    lat_tr, lat_te = cut_lineage(codes(train).select(id_col, "recon_error", *zcols)), codes(test)
    lab = top_share(lat_tr, "recon_error", contamination)
    lab = lab.withColumn("_y", F.col("flagged").cast("double"))
    va = VectorAssembler(inputCols=zcols, outputCol="latent")
    model = None
    for _ in range(rounds):
        lab = cut_lineage(lab)
        stream.release()
        model = LogisticRegression(featuresCol="latent", labelCol="_y", maxIter=50).fit(va.transform(lab))
        p1 = model.transform(va.transform(lab)).select(
            id_col, "recon_error", *zcols, vector_to_array("probability")[1].alias("_p1"))
        lab = top_share(p1, "_p1", contamination).withColumn("_y", F.col("flagged").cast("double")).drop("_p1")
    stream.release()
    out = model.transform(va.transform(lat_te))
    return out.select(id_col, "recon_error", vector_to_array("probability")[1].alias("attack_prob"),
                      F.col("prediction").cast("int").alias("pred"))


def sequence_detector(train_gaps: DataFrame, test_gaps: DataFrame, k: int = 8) -> DataFrame:
    """30-gap sequences (arrays) reconstructed by PCA fitted on normal training sequences.

    Error = mean |x - x_hat|; threshold = largest training error; a test sequence above it is anomalous.
    Inputs carry ``seq`` (array of scaled gaps) and ``seq_label``.
    """
    def vec(df):
        return df.select("*", *[F.col("seq")[i].alias(f"s{i}") for i in range(SEQ_LEN)])
    tr, te = vec(train_gaps), vec(test_gaps)
    cols = [f"s{i}" for i in range(SEQ_LEN)]
    means = tr.agg(*[F.avg(c).alias(c) for c in cols]).collect()[0]
    if means[cols[0]] is None:  # no complete normal training sequence: nothing to fit
        return te.select("end_packet_id", "seq_label", F.lit(None).cast("double").alias("seq_error"),
                         F.lit(None).cast("int").alias("pred"))
    centered = lambda d: d.select("*", *[(F.col(c) - float(means[c])).alias(f"c_{c}") for c in cols])
    ctr = centered(tr)
    pc = PCA(k=k, inputCol="features", outputCol="pc").fit(
        VectorAssembler(inputCols=[f"c_{c}" for c in cols], outputCol="features").transform(ctr)).pc.toArray()

    def err(d):
        x = [F.col(f"c_{c}") for c in cols]
        rec = linear_map(x, pc @ pc.T)
        return d.withColumn("seq_error", sum((F.abs(a - r) for a, r in zip(x, rec)), F.lit(0.0)) / SEQ_LEN)
    thr = err(ctr).agg(F.max("seq_error")).collect()[0][0]
    out = err(centered(te))
    return out.select("end_packet_id", "seq_label", "seq_error", (F.col("seq_error") > F.lit(thr)).cast("int")
                      .alias("pred"))
