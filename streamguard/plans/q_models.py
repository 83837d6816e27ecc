"""Registered queries backed by models (D*, B1-B5, B8-B11, K1-K6, M8-M9) and their scores.

Fitted models have no SQL form: their queries get the rows-only check, and
beside them stand queries of what SQL can say about them (row sets, supports,
flagged shares, kept features with their medians and moments, norms).  B5 and
K6 are exact neighbourhood operators with brute-force DuckDB text.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schema
from ..operators import evaluate as EV
from ..operators import models as MD
from ..operators import neighbors as NB
from ..operators import stats as ST
from ..operators import stream
from ..operators.detect import top_share
from ..session import cut_lineage
from . import context as ctx
from . import detection as DT
from . import oracles as O
from .q_stats import TRAIN, _prep_sql, unpivot
from .registry import query, rounded

CORE = list(schema.CORE_NUMERIC)
FULL = schema.mode_features("full")
DETECT = DT.DETECT
DBSCAN_EPS, DBSCAN_MIN = DT.DBSCAN_EPS, DT.DBSCAN_MIN
KNN_K = 5
METRICS = ["accuracy", "precision", "recall", "f1_score"]


def _train_test(spark, sf, attack_type=None):
    return tuple(DT.split(spark, sf, "full", part, attack_type) for part in ("train", "test"))


def per_attack(spark, sf, fn):
    """Run a detector once per attack type (4 distributed fits) and stack the predictions."""
    out = None
    for t in schema.ATTACK_TYPES:
        tr, te = _train_test(spark, sf, t)
        r = fn(tr, te).withColumn("attack_type", F.lit(t))
        out = r if out is None else out.unionByName(r, allowMissingColumns=True)
    return out


# ------------------------------------------------------------------ preparation


def _prepared_sql(src: str, cols) -> str:
    """CTEs of the per-attack preparation: fill -> moments, and the features that all training files keep."""
    return f"""
plong AS (SELECT * FROM {unpivot(src, cols, ("packet_id", "attack_type"), TRAIN)}),
pprof AS (SELECT attack_type, feature, COUNT(*) AS n, COUNT(value) AS nn, median(value) AS med FROM plong GROUP BY 1, 2),
pkeep AS (SELECT attack_type, feature, coalesce(med, 0.0) AS fill FROM pprof WHERE nn > 0.5 * n OR feature = 'boolean_1'),
pmom AS (SELECT attack_type, feature, avg(v) AS m, stddev_pop(v) AS s FROM
  (SELECT attack_type, feature, coalesce(value, fill) AS v FROM plong JOIN pkeep USING (attack_type, feature)) GROUP BY 1, 2 HAVING max(v) > min(v)),
{_prep_sql(src, cols)}"""


def _register_prepared(mode: str, src: str, **tables):
    cols = schema.mode_features(mode)

    @query(f"prepared_{mode}", "M2-M5, M8", O.sql(
        "SELECT p.attack_type, p.feature, " + O.r("fill", "fill") + ", " + O.r("p.m", "mean") + ", " + O.r("p.s", "deviation")
        + " FROM pmom p JOIN pkeep USING (attack_type, feature) JOIN keep2 k ON k.feature = p.feature", _prepared_sql(src, cols), **tables))
    def build(spark, sf):
        rows = []
        for t in schema.ATTACK_TYPES:
            p = DT.prepared(spark, sf, mode, t)
            rows += [(t, c, p.fills[c], *p.moments[c]) for c in p.kept]
        return spark.createDataFrame(rows, "attack_type string, feature string, fill double, mean double, deviation double")
    build.__doc__ = f"Features that the {mode} preparation of each attack type keeps, with fill values and moments."


_register_prepared("core", "typed")
_register_prepared("full", "features", full=True)
_register_prepared("new", "newf", new=True)


@query("pca_importance", "D1")
def pca_importance(spark, sf):
    """|PC1 loading| of each prepared full-mode feature (train), with its variance."""
    tr, _ = _train_test(spark, sf)
    return MD.pca_importance(tr, FULL)


@query("pca_importance_norm", "D1", O.sql(
    "SELECT COUNT(*) AS kept, 1.0 AS norm FROM keep2", _prep_sql("features", FULL), full=True))
def pca_importance_norm(spark, sf):
    """The importances are the absolute entries of a unit vector over the kept features."""
    tr, _ = _train_test(spark, sf)
    return MD.pca_importance(tr, FULL).agg(F.count(F.lit(1)).alias("kept"), F.round(F.sum(F.pow("pca_importance", F.lit(2.0))), 6).alias("norm"))


@query("select_by_importance", "M8")
def select_by_importance(spark, sf):
    """Features that the importance filter of the detectors' preparation keeps, in feature order, with their importance."""
    known = DT.importance(spark, sf, "full")
    kept = DT.prepared(spark, sf, "full").kept
    return spark.createDataFrame([(c, known[c]) for c in kept], "feature string, pca_importance double")


_ZT = ("zt AS (SELECT packet_id, feature, coalesce((coalesce(value, fill) - m) / nullif(s, 0), 0.0) AS z FROM "
       + unpivot("features", FULL, ["packet_id"], "WHERE split = 'test'") + " JOIN keep1 USING (feature) JOIN keep2 USING (feature))")
_COMB = ("comb AS (SELECT feature FROM (SELECT feature, COUNT(*) AS n, COUNT(value) AS nn, coalesce(median(value), 0.0) AS f FROM long GROUP BY feature) "
         "JOIN keep2 USING (feature) WHERE nn >= 0.5 * n)")


@query("assemble", "M9", O.sql(
    "SELECT packet_id, COUNT(*) AS dims, " + O.r("SUM(z * z)", "sq_norm", 4) + " FROM zt JOIN comb USING (feature) GROUP BY packet_id",
    _prep_sql("features", FULL, strict=True, keep_always=["boolean_1"]), _ZT, _COMB, full=True))
def assemble(spark, sf):
    """Prepared detection matrix as one vector per packet (test rows, fitted on train)."""
    from pyspark.ml.functions import vector_to_array
    _, te = _train_test(spark, sf)
    v = vector_to_array("features")
    z = DT.prepared(spark, sf, "full").transform(te)
    return z.select("packet_id", F.size(v).alias("dims"), F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x), 4).alias("sq_norm"))


@query("pca_project", "D2")
def pca_project(spark, sf):
    """Two principal coordinates per attack type with explained variance (train, nulls -> 0)."""
    tr, _ = _train_test(spark, sf)
    return MD.pca_project(tr, CORE)


@query("rf_importance", "D3")
def rf_importance(spark, sf):
    """Random-forest importances (200 trees, seed 42) of the prepared full-mode features."""
    tr, _ = _train_test(spark, sf)
    return MD.rf_importance(tr, FULL)


@query("pca_latent", "D4")
def pca_latent(spark, sf):
    """16-d latent code and reconstruction error of every test packet (fitted on train)."""
    tr, te = _train_test(spark, sf)
    z, zc = MD.pca_latent(tr, te, DETECT)
    return z.select("packet_id", *zc, "recon_error")


_NORM = ", ".join(f"avg(coalesce(CAST({c} AS DOUBLE), 0.0)) AS m_{i}, stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) AS s_{i}"
                  for i, c in enumerate(DETECT))
_SQ = " + ".join(f"CASE WHEN s_{i} > 1e-12 * greatest(1.0, abs(m_{i})) THEN pow((coalesce(CAST({c} AS DOUBLE), 0.0) - m_{i}) / s_{i}, 2) ELSE 0.0 END"
                 for i, c in enumerate(DETECT))


@query("latent_norm", "D4", O.sql(
    "SELECT packet_id, " + O.r(_SQ, "sq_norm", 4) + " FROM features, lm WHERE split = 'test'",
    f"lm AS (SELECT {_NORM} FROM features WHERE split = 'train')", full=True))
def latent_norm(spark, sf):
    """Squared length of every test packet, put together from its latent code and its reconstruction error."""
    tr, te = _train_test(spark, sf)
    z, zc = MD.pca_latent(tr, te, DETECT)
    code = sum((F.col(c) * F.col(c) for c in zc), F.lit(0.0))
    return z.select("packet_id", F.round(code + F.col("recon_error") * len(DETECT), 4).alias("sq_norm"))


# ------------------------------------------------------------------ binary detectors


def _detector(spark, sf, model, score=None):
    d = DT.predictions(spark, sf, "full", model).filter(F.col("split") == "test")
    return d.select("packet_id", *([F.col("score").alias(score)] if score else []), "pred", "attack_type")


@query("isolation_forest", "B1")
def isolation_forest(spark, sf):
    """Isolation forest per attack type on the prepared features; contamination = clamped train attack ratio."""
    return _detector(spark, sf, "isolation_forest", "if_score")


@query("one_class_svm", "B2")
def one_class_svm(spark, sf):
    """RBF one-class SVM (random Fourier features, nu = contamination) per attack type on the prepared features."""
    return _detector(spark, sf, "one_class_svm", "ocsvm_score")


@query("kmeans_minority", "B3")
def kmeans_minority(spark, sf):
    """K-means (k = 2, best of 10 seeds): the smaller predicted cluster is the attack, per attack type."""
    return _detector(spark, sf, "kmeans", "cluster").withColumn("cluster", F.col("cluster").cast("int"))


@query("gmm_minority", "B4")
def gmm_minority(spark, sf):
    """Gaussian mixture (2 components): the smaller predicted component is the attack, per attack type."""
    return _detector(spark, sf, "gmm", "cluster").withColumn("cluster", F.col("cluster").cast("int"))


_MODELS = ", ".join(f"('{m}', '{x}')" for m, names in DT.BINARY_MODELS.items() for x in names)


@query("detector_support", "E11, B1-B5", O.sql(
    "SELECT mode, attack_type, model, n, packets, positives, n AS scored FROM (VALUES " + _MODELS + ") x(mode, model), "
    "(SELECT attack_type, COUNT(*) AS n, COUNT(DISTINCT packet_id) AS packets, CAST(SUM(attack) AS BIGINT) AS positives FROM typed "
    "WHERE split = 'test' GROUP BY attack_type)"))
def detector_support(spark, sf):
    """Per mode, attack type and detector: test rows predicted, distinct packets, true attacks, rows with a score."""
    return DT.all_predictions(spark, sf).filter(F.col("split") == "test").groupBy("mode", "attack_type", "model").agg(
        F.count("pred").alias("n"), F.count_distinct("packet_id").alias("packets"), F.sum("y").alias("positives"), F.count("score").alias("scored"))


@query("detector_shares", "B1-B4, B6", O.sql(
    "SELECT mode, attack_type, model, n, contamination, CAST(1 AS BIGINT) AS within FROM (VALUES " + _MODELS + ") x(mode, model), "
    "(SELECT attack_type, COUNT(*) AS n, " + O.r("greatest(0.01, least(0.5, AVG(attack)))", "contamination") + " FROM typed "
    "WHERE split = 'train' GROUP BY attack_type) WHERE model IN ('gmm', 'isolation_forest', 'kmeans', 'one_class_svm')"))
def detector_shares(spark, sf):
    """Rows flagged in training: at most contamination for the quantile thresholds, at most half for the minority rule."""
    d = DT.all_predictions(spark, sf, ["gmm", "isolation_forest", "kmeans", "one_class_svm"]).filter(F.col("split") == "train")
    g = d.groupBy("mode", "attack_type", "model").agg(F.count(F.lit(1)).alias("n"), F.sum("pred").alias("flagged"), F.avg(F.col("y").cast("double")).alias("ratio"))
    share = F.greatest(F.lit(DT.MIN_CONTAMINATION), F.least(F.lit(DT.MAX_CONTAMINATION), F.col("ratio")))
    limit = F.when(F.col("model").isin("kmeans", "gmm"), F.col("n") / 2).otherwise(share * F.col("n") + 1)
    return g.select("mode", "attack_type", "model", "n", share.alias("contamination"), (F.col("flagged") <= limit).cast("bigint").alias("within"))


def _scores(spark, sf):
    d = DT.all_predictions(spark, sf).filter(F.col("split") == "test").withColumnRenamed("pred", "p")
    return EV.binary_metrics(d, ["mode", "attack_type", "model"])


@query("model_table_detectors", "E11")
def model_table_detectors(spark, sf):
    """One row per mode, attack type and fitted detector: counts, accuracy, precision, recall, F1 variants, rank by F1."""
    w = Window.partitionBy("mode", "attack_type").orderBy(rounded(F.col("f1_score")).desc(), F.col("model"))
    return _scores(spark, sf).withColumn("f1_rank", F.row_number().over(w))


@query("cross_attack_detectors", "E12")
def cross_attack_detectors(spark, sf):
    """Per mode and detector: mean and sample deviation of each metric over the attack types."""
    m = _scores(spark, sf).withColumn("detector", F.concat_ws(":", "mode", "model"))
    return EV.cross_summary(m, "detector", METRICS)


@query("f1_pivot_detectors", "E13")
def f1_pivot_detectors(spark, sf):
    """Detector x attack type F1 table."""
    return _scores(spark, sf).groupBy("mode", "model").pivot("attack_type", schema.ATTACK_TYPES).agg(F.max("f1_score"))


@query("best_detectors", "E14")
def best_detectors(spark, sf):
    """Best fitted detector per mode and attack type by F1."""
    return EV.best_by(_scores(spark, sf).withColumn("f1_score", rounded(F.col("f1_score"))), ["mode", "attack_type"], "f1_score")


@query("confusion_detectors", "E3")
def confusion_detectors(spark, sf):
    """Dense 2 x 2 confusion table per mode, attack type and fitted detector."""
    d = DT.all_predictions(spark, sf).filter(F.col("split") == "test").withColumnRenamed("pred", "p")
    return EV.confusion_binary(d, ["mode", "attack_type", "model"])


@query("auc_detectors", "E8")
def auc_detectors(spark, sf):
    """ROC AUC of the detectors with an anomaly score, per mode and attack type."""
    d = DT.all_predictions(spark, sf, ["isolation_forest", "one_class_svm"]).filter(F.col("split") == "test")
    d = d.withColumn("score", F.when(F.col("model") == "one_class_svm", -F.col("score")).otherwise(F.col("score")))
    return EV.roc_auc(d, ["mode", "attack_type", "model"])


def _dbscan_points(spark, sf):
    tr, te = _train_test(spark, sf)
    mx = MD.Matrix(tr, CORE, zero_fill=True)
    z = mx.z(te)
    return z.select("packet_id", F.array(*[F.col(c).cast("double") for c in mx.kept]).alias("v"))


_Z = ", ".join(f"CASE WHEN s_{i} > 0 THEN (coalesce(CAST({c} AS DOUBLE), 0.0) - m_{i}) / s_{i} ELSE 0.0 END"
               for i, c in enumerate(CORE))
_M = ", ".join(f"avg(coalesce(CAST({c} AS DOUBLE), 0.0)) AS m_{i}, stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) "
               f"AS s_{i}" for i, c in enumerate(CORE))
_DBSCAN_SQL = O.sql(
    "SELECT packet_id, neighbours, CAST(neighbours >= 50 AS BIGINT) AS is_core, CAST(neighbours < 50 AND NOT EXISTS "
    "(SELECT 1 FROM pairs q JOIN nb c ON c.packet_id = q.b WHERE q.a = nb.packet_id AND c.neighbours >= 50) AS BIGINT) "
    "AS is_noise FROM nb",
    f"mo AS (SELECT {_M} FROM typed WHERE split = 'train')",
    f"pts AS (SELECT packet_id, [{_Z}] AS v FROM typed, mo WHERE split = 'test')",
    "pairs AS (SELECT a.packet_id AS a, b.packet_id AS b FROM pts a JOIN pts b "
    "ON list_distance(a.v, b.v) <= 3.0)",
    "nb AS (SELECT a AS packet_id, COUNT(*) AS neighbours FROM pairs GROUP BY a)")


@query("dbscan_noise", "B5", _DBSCAN_SQL)
def dbscan_noise(spark, sf):
    """DBSCAN core / noise flags (eps 3.0, min 50 incl. self) on standardized core features of the test set."""
    return NB.dbscan_flags(_dbscan_points(spark, sf), "packet_id", "v", DBSCAN_EPS, DBSCAN_MIN)


def _knn_split(spark, sf):
    e = ctx.table(spark, sf, "embeddings").select(
        F.col("vec_id"), F.col("embedding").cast("array<double>").alias("v"), "label")
    bucket = F.conv(F.substring(F.md5(F.col("vec_id").cast("string")), 1, 8), 16, 10).cast("bigint") % 5
    return e.filter(bucket != 0), e.filter(bucket == 0)


_KNN_SQL = (
    "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, "
    "CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS b FROM embeddings), "
    "d AS (SELECT t.vec_id AS it, r.vec_id AS ir, r.label, list_distance(t.v, r.v) AS d2 "
    "FROM e t JOIN e r ON t.b = 0 AND r.b <> 0), "
    "top AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY it ORDER BY d2, ir) AS rk FROM d) WHERE rk <= 5), "
    "votes AS (SELECT it, label, COUNT(*) AS v FROM top GROUP BY it, label) "
    "SELECT it AS vec_id, CAST(label AS BIGINT) AS pred FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY it "
    "ORDER BY v DESC, label) AS rk FROM votes) WHERE rk = 1")


@query("knn_assign", "K6", _KNN_SQL)
def knn_assign(spark, sf):
    """Each held-out embedding takes the majority label of its 5 nearest training embeddings."""
    tr, te = _knn_split(spark, sf)
    return NB.knn_assign(tr, te, "vec_id", "v", "label", k=KNN_K)


# ------------------------------------------------------------------ five classes


def _clustering(spark, sf, model):
    return DT.class_predictions(spark, sf, [model]).drop("model")


@query("kmeans5", "K1")
def kmeans5(spark, sf):
    """K-means with 5 clusters (best of 20 seeds) on the prepared matrix; clusters mapped to classes on train."""
    return _clustering(spark, sf, "kmeans")


@query("gmm5", "K2")
def gmm5(spark, sf):
    """Gaussian mixture with 5 components; components mapped to classes on train."""
    return _clustering(spark, sf, "gmm")


@query("hierarchical5", "K3")
def hierarchical5(spark, sf):
    """Hierarchical clustering into 5 groups from the top down (bisecting K-means), mapped to classes."""
    return _clustering(spark, sf, "bisecting")


@query("latent_kmeans", "K4")
def latent_kmeans(spark, sf):
    """K-means (best of 10 seeds) in the 16-d latent space, mapped to classes."""
    return _clustering(spark, sf, "latent_kmeans")


@query("projected_kmeans", "K5")
def projected_kmeans(spark, sf):
    """K-means (best of 10 seeds) in a 2-d projection, mapped to classes."""
    return _clustering(spark, sf, "projected_kmeans")


_CLASS = "CASE WHEN attack = 0 THEN 'normal' ELSE lower(attack_type) END"


@query("multiclass_support", "K1-K5, E5", O.sql(
    "SELECT model, cls, CAST(support AS BIGINT) AS support, n AS packets, CAST(0 AS BIGINT) AS outside FROM (VALUES "
    + ", ".join(f"('{m}')" for m in DT.CLASS_MODELS) + ") m(model), (VALUES " + ", ".join(f"('{c}')" for c in schema.CLASSES) + ") c(cls), "
    "(SELECT COUNT(*) AS n FROM typed WHERE split = 'test') t, LATERAL (SELECT COUNT(*) AS support FROM typed WHERE split = 'test' AND " + _CLASS + " = cls) s"))
def multiclass_support(spark, sf):
    """Per clustering and class: true rows, packets predicted in all, predictions that are no class."""
    d = DT.class_predictions(spark, sf)
    names = F.array(*[F.lit(c) for c in schema.CLASSES])
    counts = [F.count_if(F.col("y") == i).alias(f"s{i}") for i in range(len(schema.CLASSES))]
    g = d.groupBy("model").agg(F.count_distinct("packet_id").alias("packets"),
                               F.count_if(F.col("pred").isNull() | ~F.col("pred").between(0, len(schema.CLASSES) - 1)).alias("outside"), *counts)
    each = F.explode(F.arrays_zip(names.alias("cls"), F.array(*[F.col(f"s{i}") for i in range(len(schema.CLASSES))]).alias("support")))
    return g.select("model", "packets", "outside", each.alias("x")).select("model", F.col("x.cls").alias("cls"), F.col("x.support").alias("support"), "packets", "outside")


@query("multiclass_model_table", "E5, E6, E11")
def multiclass_model_table(spark, sf):
    """Per clustering: accuracy, macro precision, recall and F1, and the F1 of each class (test)."""
    d = DT.class_predictions(spark, sf).withColumnRenamed("pred", "p")
    per = EV.per_class_metrics(d, ["model"], list(range(len(schema.CLASSES))))
    macro = EV.classification_report(per, ["model"]).filter(F.col("row") == "macro avg").select(
        "model", F.col("precision").alias("precision_macro"), F.col("recall").alias("recall_macro"), F.col("f1").alias("f1_macro"))
    each = per.groupBy("model").agg(*[F.max(F.when(F.col("cls") == i, F.col("f1"))).alias(f"f1_{c}") for i, c in enumerate(schema.CLASSES)])
    hits = d.groupBy("model").agg(F.avg((F.col("y") == F.col("p")).cast("double")).alias("accuracy"))
    return hits.join(macro, "model").join(each, "model")


@query("confusion_multiclass", "E4")
def confusion_multiclass(spark, sf):
    """5 x 5 confusion table of every clustering (test)."""
    d = DT.class_predictions(spark, sf).withColumnRenamed("pred", "p").filter(F.col("p") >= 0)
    return EV.confusion_multi(d, ["model"], len(schema.CLASSES))


@query("pseudo_label_classifier", "B8")
def pseudo_label_classifier(spark, sf):
    """Reconstruction-error pseudo labels (top 7.6 %), logistic model on the latent code, relabel, refit."""
    tr, te = _train_test(spark, sf)
    return MD.reconstruction_detector(tr, te, DETECT)


@query("per_attack_detector", "B9")
def per_attack_detector(spark, sf):
    """The pseudo-label detector once per attack type, contamination = that type's train attack ratio."""
    return per_attack(spark, sf, lambda tr, te: MD.reconstruction_detector(tr, te, DETECT, DT.contamination(tr)))


def _gap_sequences(spark, sf, split):
    """Sequences of device gaps, nulls as 0, scaled by the range of the normal training gaps for either split."""
    f = ctx.full(spark, sf)
    gap = F.coalesce("inter_arrival", F.lit(0.0))
    normal = f.filter((F.col("split") == "train") & (F.col("attack") == 0))
    lo, hi = (float(x or 0.0) for x in normal.agg(F.min(gap), F.max(gap)).first())
    scaled = f.filter(F.col("split") == split).withColumn("_g", (gap - F.lit(lo)) / F.lit((hi - lo) or 1.0))
    s = stream.segmented(scaled, schema.DEVICE, "base_time", reuse=True)

    def build(d, w):
        frame = w.rowsBetween(-(MD.SEQ_LEN - 1), 0)
        return d.withColumn("seq", F.collect_list("_g").over(frame)).withColumn("seq_label", F.max("attack").over(frame))
    s = stream.windowed(s, schema.DEVICE, [F.col("base_time").asc_nulls_last(), F.col("packet_id")], build,
                        MD.SEQ_LEN)
    return s.filter(F.size("seq") == MD.SEQ_LEN).select(F.col("packet_id").alias("end_packet_id"), "seq", "seq_label")


@query("sequence_anomaly", "B10")
def sequence_anomaly(spark, sf):
    """Sequences of 30 scaled device gaps; PCA reconstruction fitted on normal train sequences; max-error threshold."""
    tr = _gap_sequences(spark, sf, "train").filter(F.col("seq_label") == 0)
    te = _gap_sequences(spark, sf, "test")
    return MD.sequence_detector(tr, te)


@query("recon_error_stats", "B11")
def recon_error_stats(spark, sf):
    """Mean / std of reconstruction error by split x label and the train threshold at index int(n (1 - c))."""
    tr, te = _train_test(spark, sf)
    codes, _ = MD.latent_model(tr, DETECT)
    errors = lambda d: codes(d).select("packet_id", "attack", "recon_error")
    a, b = cut_lineage(errors(tr)), errors(te)  # the training errors are also ranked
    both = a.withColumn("split", F.lit("train")).unionByName(b.withColumn("split", F.lit("test")))
    stats = both.groupBy("split", "attack").agg(F.avg("recon_error").alias("mean_error"),
                                               F.stddev_samp("recon_error").alias("std_error"))
    flagged = top_share(a.select("packet_id", "recon_error"), "recon_error", MD.UCAD_CONTAMINATION)
    thr = flagged.filter(F.col("flagged") == 1).agg(F.min("recon_error").alias("threshold"))
    least = thr.first()[0]
    stream.release()
    return stats.withColumn("threshold", F.lit(least))
