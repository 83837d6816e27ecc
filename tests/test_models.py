"""Properties of the model-backed operators (they have no SQL form)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from streamguard import schema
from streamguard.operators import cluster as CL
from streamguard.operators import evaluate as EV
from streamguard.operators import models as MD
from streamguard.operators.detect import top_share
from streamguard.plans import context


def test_assignment_is_one_to_one_and_optimal():
    t = pd.DataFrame([(c, l, n) for c, l, n in [(0, 0, 50), (0, 1, 5), (1, 1, 40), (2, 2, 30), (2, 0, 31),
                                                (3, 0, 2)]], columns=["cluster", "label", "n"])
    m = dict(zip(*CL.assign(t).T.values))
    assert m[0] == 0 and m[1] == 1 and m[2] == 2  # one-to-one on the best total (50 + 40 + 30)
    assert m[3] == 0  # leftover cluster -> its majority class


def test_hungarian_matches_brute_force():
    rng = np.random.default_rng(3)
    w = rng.integers(0, 100, size=(4, 7)).astype(float)
    pairs = CL._hungarian(w)
    import itertools
    best = max(sum(w[i, p[i]] for i in range(4)) for p in itertools.permutations(range(7), 4))
    assert sum(w[i, j] for i, j in pairs) == best


def test_top_share_flags_the_share(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("packet_id"), (F.col("id") * 7 % 1000).cast("double").alias("s"))
    got = top_share(df, "s", 0.1).agg(F.sum("flagged")).first()[0]
    assert got == 100


def test_auc_is_one_on_separable_scores(spark):
    rows = [("a", 1, float(100 + i)) for i in range(20)] + [("a", 0, float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "attack_type string, y int, score double")
    auc = EV.roc_auc(df, ["attack_type"]).first()["roc_auc"]
    assert auc == 1.0


def test_pca_loadings_have_unit_norm(spark):
    tr = context.full(spark, SF_SMALL).filter(F.col("split") == "train")
    imp = MD.pca_importance(tr, schema.mode_features("full")).select("pca_importance").toPandas()
    assert abs(float((imp["pca_importance"] ** 2).sum()) - 1.0) < 1e-9


def test_kmeans_keeps_the_cheapest_restart(spark):
    tr = context.full(spark, SF_SMALL).filter(F.col("split") == "train")
    v = MD.Matrix(tr, schema.UCAD_FEATURES, strict=True, always_keep=["boolean_1"]).vectors(tr).persist()
    costs = [MD.kmeans_restarts(v, 5, 20, n).summary.trainingCost for n in (1, 4)]
    assert costs[1] <= costs[0] * (1 + 1e-8)


def test_kmeans_is_seeded(spark):
    tr = context.full(spark, SF_SMALL).filter(F.col("split") == "train")
    mx = MD.Matrix(tr, schema.UCAD_FEATURES, strict=True, always_keep=["boolean_1"])
    v = mx.vectors(tr)
    a = MD.fit_predict_clusters(v, v, "kmeans", 5).select("packet_id", "cluster").collect()
    b = MD.fit_predict_clusters(v, v, "kmeans", 5).select("packet_id", "cluster").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_preparation_fits_saves_and_groups_alike(spark, tmp_path):
    """The pipeline equals numpy, its saved model and the fit of all groups in one pass."""
    from streamguard.operators.prepare import Prepared
    rng = np.random.default_rng(4)
    n = 400
    x = pd.DataFrame({"g": np.where(np.arange(n) % 3 == 0, "a", "b"), "packet_id": np.arange(n), "u": rng.normal(5, 2, n), "half": rng.normal(0, 1, n),
                      "const": 7.0, "boolean_1": 1.0, "odd": rng.normal(0, 1, n), "weak": rng.normal(0, 1, n)})
    x.loc[x.index % 5 < 3, "half"] = np.nan
    x.loc[x.index % 9 != 0, "boolean_1"] = np.nan
    x.loc[1, "odd"], x.loc[2, "odd"], x.loc[3, "u"] = np.inf, -np.inf, np.nan
    df = spark.createDataFrame(x)
    features = ["u", "half", "const", "boolean_1", "odd", "weak"]
    known = {"u": 0.5, "odd": 0.2, "weak": 0.01, "boolean_1": 0.3}
    for g, p in Prepared.fit_groups(df, "g", features, known, 0.1).items():
        one = Prepared.fit(df.filter(F.col("g") == g), features, known, 0.1)
        one.save(str(tmp_path / g))
        again = Prepared.load(str(tmp_path / g))
        sub = x[x.g == g].replace([np.inf, -np.inf], np.nan)
        want = {c: sub[c].fillna(sub[c].median()) for c in ("u", "odd")}
        for q in (p, one, again):
            assert q.kept == ["u", "odd"] and abs(q.fills["u"] - sub["u"].median()) < 1e-12
            z = q.transform(df.filter(F.col("g") == g)).orderBy("packet_id").toPandas()
            for c, v in want.items():
                assert np.allclose(z[c], (v - v.mean()) / v.std(ddof=0))
            assert np.allclose(np.stack([r.toArray() for r in z["features"]]), z[["u", "odd"]])
    assert Prepared.fit(df, features, {"u": 0.1, "odd": 0.2}, 0.9).kept == ["u", "odd"]  # none reaches it: the most important ones


def test_one_class_flags_at_most_its_share(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, *map(float, rng.normal(0, 1, 3) + (8 if i % 20 == 0 else 0))) for i in range(600)], "packet_id long, a double, b double, c double")
    tr, te = MD.one_class_rff(df, df, ["a", "b", "c"], 0.05)
    assert 20 <= tr.agg(F.sum("pred")).first()[0] <= 30 and te.count() == 600
    a, b = MD.isolation_forest(df, df, ["a", "b", "c"], 0.05)
    assert a.agg(F.sum("pred")).first()[0] <= 30 and b.filter("packet_id % 20 = 0").agg(F.avg("pred")).first()[0] > 0.8


def test_kmeans_restarts_step_side_by_side(spark):
    """The passes shared by all restarts end at the costs of separate fits; the model is that of the cheapest seed."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (500, 3)) + rng.integers(0, 7, 500)[:, None] * 1.5
    df = spark.createDataFrame([(x[i].tolist(),) for i in range(500)], "a array<double>").select(array_to_vector("a").alias("features")).persist()
    fits = [KMeans(k=4, seed=MD.SEED + i, maxIter=30).fit(df) for i in range(3)]
    starts = [np.stack(KMeans(k=4, seed=MD.SEED + i, maxIter=0).fit(df).clusterCenters()) for i in range(3)]
    want = [f.summary.trainingCost for f in fits]
    assert np.allclose(MD.restart_costs(df, starts, 30, 1e-4), want, rtol=1e-9)
    got = MD.kmeans_restarts(df, 4, 30, 3)
    assert np.allclose(got.clusterCenters(), fits[int(np.argmin([float(f"{c:.8e}") for c in want]))].clusterCenters())


def test_pseudo_labels_rank_rows_cut_from_lineage(spark, monkeypatch):
    """The codes are computed once, and the ranked frames are let go."""
    from streamguard.operators import stream
    plans = []

    def ranked(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return top_share(df, *args)
    monkeypatch.setattr(MD, "top_share", ranked)
    rng = np.random.default_rng(7)
    rows = [(i, *map(float, rng.normal(0, 1, 3) + (9 if i % 20 == 0 else 0))) for i in range(300)]
    df = spark.createDataFrame(rows, "packet_id long, a double, b double, c double")
    stream.release()
    out = MD.reconstruction_detector(df, df, ["a", "b", "c"], 0.05)
    assert len(plans) == 3 and not any("latent" in p.replace("latent#", "") and "Python" in p for p in plans)
    assert not stream._PERSISTED and out.count() == 300


def test_forest_paths_equal_a_walk_down_each_tree():
    """Path lengths of whole blocks, bit for bit those of single rows, without a pass over all columns per level."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(MD.BLOCK_ROWS + 7, 4))
    rest = lambda n: np.where(np.asarray(n, float) > 1, np.log(np.maximum(np.asarray(n, float), 1)) + 0.1, 0.0)
    trees = [np.array([(0, 0, 2, 0.1, 1, 4, 9), (0, 1, 0, -0.3, 2, 3, 6), (0, 2, -1, 0, -1, -1, 2), (0, 3, -1, 0, -1, -1, 4), (0, 4, -1, 0, -1, -1, 3)]),
             np.array([(1, 0, -1, 0.0, -1, -1, 5)])]

    def walk(row, nodes):
        at, depth = 0, 0.0
        while nodes[at, 2] >= 0:
            at, depth = int(nodes[at, 4] if row[int(nodes[at, 2])] < nodes[at, 3] else nodes[at, 5]), depth + 1
        return depth + float(rest(nodes[at, 6]))
    got = MD._path_lengths(x, [MD._flat_tree(t, rest) for t in trees])
    assert got.tolist() == [sum((walk(row, t) for t in trees), 0.0) for row in x]


def test_a_filter_on_the_reconstruction_error_stays_above_the_codes(spark):
    """Pushed below them it was written out in every mixture of the features' names and expressions, and filled the driver."""
    rng = np.random.default_rng(8)
    cols = [f"f{i}" for i in range(8)]
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(rng.normal(0, 1, (60, 8)))], "packet_id long, " + ", ".join(f"{c} double" for c in cols))
    apply, _ = MD.latent_model(df, cols, 3)
    held = apply(df).select("packet_id", "recon_error").filter(F.col("recon_error").isNotNull())
    assert held._jdf.queryExecution().optimizedPlan().toString().count("latent(") == 1
    assert held.count() == 60


def test_mixture_steps_equal_the_estimator(spark):
    """Steps by matrix products end at the components, the assignments and the number of steps of Spark's estimator."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(10)
    x = rng.normal(0, 1, (900, 4)) * (1 + np.arange(4)) + rng.integers(0, 3, 900)[:, None] * 6.0
    x[:, 3] = x[:, 0]  # a covariance without an inverse
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, a array<double>").select("i", array_to_vector("a").alias("features")).persist()
    for steps in (3, 60):
        want = GaussianMixture(k=3, seed=MD.SEED, maxIter=steps, predictionCol="cluster").fit(df)
        weights, means, covariances = MD.gaussian_mixture(df, 3, steps)
        assert np.allclose(weights, want.weights, rtol=1e-6)
        for i, r in enumerate(want.gaussiansDF.collect()):
            assert np.allclose(means[i], r["mean"].toArray(), rtol=1e-6) and np.allclose(covariances[i], r["cov"].toArray(), rtol=1e-5, atol=1e-8)
        both = want.transform(df).select("i", "cluster").join(MD.mixture_assign(weights, means, covariances)(df).select("i", F.col("cluster").alias("own")), "i")
        assert both.filter("cluster <> own").count() == 0 and both.count() == 900


def test_large_mixtures_are_fitted_in_blocks(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(11)
    x = rng.normal(0, 1, (300, 2)) + rng.integers(0, 2, 300)[:, None] * 9.0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, a array<double>").select("i", array_to_vector("a").alias("features")).persist()
    steps, summed, found = [], MD._summed, []
    monkeypatch.setattr(MD, "_summed", lambda *a: steps.append(1) or summed(*a))
    for work in (MD.BLOCK_WORK, 300 * 2 * 4):
        monkeypatch.setattr(MD, "BLOCK_WORK", work)
        found.append({r["i"]: r["cluster"] for r in MD.cluster_model(df, "gmm", 2, 50)(df).collect()})
        assert bool(steps) == (work == 300 * 2 * 4)
    assert found[0] == found[1] and len(found[0]) == 300
    assert MD.cluster_model(df, "gmm", 2, 1)(df).columns == ["i", "features", "cluster"]


def test_detectors_are_fitted_two_at_a_time(spark, monkeypatch):
    """Each of two fits waits for the other: one after the other they would never meet."""
    import threading
    from streamguard.plans import detection as DT
    met = threading.Barrier(2, timeout=60)

    def fitted(spark, sf, mode, model):
        met.wait()
        return spark.createDataFrame([(mode, model)], "mode string, model string")
    monkeypatch.setattr(DT, "frame", lambda *a: None)
    monkeypatch.setattr(DT, "_ready", lambda *a: None, raising=False)
    monkeypatch.setattr(DT, "predictions", fitted)
    got = DT.all_predictions(spark, "none", ["gmm", "kmeans"]).collect()
    assert [tuple(r) for r in got] == [(mode, m) for mode in ("core", "full") for m in ("gmm", "kmeans")]
