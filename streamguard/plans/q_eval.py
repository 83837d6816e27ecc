"""Registered queries: rule detectors, evaluation, cluster mapping and graph (E*, K7-K9, J4, J6, B6, B7, R*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schema
from ..operators import cluster as CL
from ..operators import evaluate as EV
from ..operators import graph as GR
from ..operators import sampling as SA
from . import context as ctx
from . import oracles as O
from .registry import query, rounded

# Protocol-rule detectors evaluated as binary models (flag -> attack).
RULES = {
    "ttl_rule": ("ttl_violation", "CAST(ttl_violation AS INT)"),
    "heartbeat_rule": ("1 - heartbeat_within_tol", "CAST(1 - heartbeat_within_tol AS INT)"),
    "sequence_rule": ("sq_inc_violation_when_no_event", "CAST(sq_inc_violation_when_no_event AS INT)"),
    "reset_rule": ("sq_reset_violation", "CAST(sq_reset_violation AS INT)"),
    "status_rule": ("coalesce(status_change_violation_on_heartbeat, 0)",
                    "CAST(coalesce(status_change_violation_on_heartbeat, 0) AS INT)"),
}
# Rule signatures used as clusterings (3 flags -> code 0..7).
SIGNATURES = {
    "sig_timing": ("4 * ttl_violation + 2 * sq_inc_violation_when_no_event + sq_reset_violation"),
    "sig_state": ("4 * (1 - heartbeat_within_tol) + 2 * stNum_jump_gt1 "
                  "+ coalesce(status_change_violation_on_heartbeat, 0)"),
}
SCORE = "heartbeat_interval_error"  # anomaly score evaluated by the curve metrics
CLASS_CASE = ("CASE (CASE WHEN attack = 0 THEN 'normal' ELSE lower(attack_type) END) "
              + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(schema.CLASSES)) + " END")


def rule_preds(spark, sf, split: str = "test"):
    """Long (packet_id, attack_type, model, y, p) for every rule detector."""
    f = ctx.full(spark, sf).filter(F.col("split") == split)
    wide = f.select("packet_id", "attack_type", F.col("attack").alias("y"),
                    *[F.expr(e).cast("int").alias(m) for m, (e, _) in RULES.items()])
    return wide.unpivot(["packet_id", "attack_type", "y"], list(RULES), "model", "p")


def _preds_sql(split: str = "test") -> str:
    return "preds AS (" + " UNION ALL ".join(
        f"SELECT packet_id, attack_type, attack AS y, '{m}' AS model, {s} AS p FROM features WHERE split = '{split}'"
        for m, (_, s) in RULES.items()) + ")"


_COUNTS = ("cnt AS (SELECT attack_type, model, COUNT(*) FILTER (WHERE y = 1 AND p = 1) AS tp, "
           "COUNT(*) FILTER (WHERE y = 0 AND p = 1) AS fp, COUNT(*) FILTER (WHERE y = 0 AND p = 0) AS tn, "
           "COUNT(*) FILTER (WHERE y = 1 AND p = 0) AS fn FROM preds GROUP BY attack_type, model)")


def _z(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


_MET = ("met AS (SELECT attack_type, model, tp, fp, tn, fn, " + _z("tp + tn", "tp + fp + tn + fn") + " AS accuracy, "
        + _z("tp", "tp + fp") + " AS precision, " + _z("tp", "tp + fn") + " AS recall, "
        + _z("2 * tp", "2 * tp + fp + fn") + " AS f1_score, (" + _z("2 * tp", "2 * tp + fp + fn") + " + "
        + _z("2 * tn", "2 * tn + fn + fp") + ") / 2 AS f1_macro, " + _z(
            f"{_z('2 * tp', '2 * tp + fp + fn')} * (tp + fn) + {_z('2 * tn', '2 * tn + fn + fp')} * (tn + fp)",
            "tp + fp + tn + fn") + " AS f1_weighted FROM cnt)")
_EVAL = [_preds_sql(), _COUNTS, _MET]
_METRICS = ["accuracy", "precision", "recall", "f1_score"]


def metrics(spark, sf):
    return EV.binary_metrics(rule_preds(spark, sf), ["attack_type", "model"])


@query("binary_metrics", "E1", O.sql(
    "SELECT attack_type, model, tp, fp, tn, fn, " + ", ".join(O.r(m, m) for m in _METRICS) + " FROM met",
    *_EVAL, full=True))
def binary_metrics(spark, sf):
    """Accuracy, precision, recall and F1 of every rule detector per attack type (test)."""
    return metrics(spark, sf).select("attack_type", "model", "tp", "fp", "tn", "fn", *_METRICS)


@query("f1_variants", "E2", O.sql(
    "SELECT attack_type, model, " + O.r("f1_macro", "f1_macro") + ", " + O.r("f1_weighted", "f1_weighted")
    + " FROM met", *_EVAL, full=True))
def f1_variants(spark, sf):
    """Macro and weighted F1 over both classes."""
    return metrics(spark, sf).select("attack_type", "model", "f1_macro", "f1_weighted")


@query("confusion_binary", "E3", O.sql(
    "SELECT attack_type, model, CAST(y AS BIGINT) AS y, CAST(p AS BIGINT) AS p, n, "
    + O.r("coalesce(n / nullif(SUM(n) OVER (PARTITION BY attack_type, model, y),"
                                                 " 0), 0)", "row_share")
    + " FROM (SELECT attack_type, model, 0 AS y, 0 AS p, tn AS n FROM cnt UNION ALL SELECT attack_type, model, 0, 1, fp "
    "FROM cnt UNION ALL SELECT attack_type, model, 1, 0, fn FROM cnt UNION ALL SELECT attack_type, model, 1, 1, tp FROM cnt)",
    *_EVAL, full=True))
def confusion_binary(spark, sf):
    """Dense 2 x 2 confusion table per detector and attack type, with row shares."""
    return EV.confusion_binary(rule_preds(spark, sf), ["attack_type", "model"])


@query("model_table", "E11", O.sql(
    "SELECT attack_type, model, " + ", ".join(O.r(m, m) for m in _METRICS)
    + ", CAST(ROW_NUMBER() OVER (PARTITION BY attack_type ORDER BY " + O.rx("f1_score")
    + " DESC, model) AS BIGINT) AS f1_rank FROM met", *_EVAL, full=True))
def model_table(spark, sf):
    """One row per attack type x detector, ranked by F1."""
    m = metrics(spark, sf)
    w = Window.partitionBy("attack_type").orderBy(rounded(F.col("f1_score")).desc(), F.col("model"))
    return m.select("attack_type", "model", *_METRICS, F.row_number().over(w).alias("f1_rank"))


@query("cross_attack_summary", "E12", O.sql(
    "SELECT model, " + ", ".join(f"{O.r(f'avg({m})', f'{m}_mean', 4)}, {O.r(f'stddev_samp({m})', f'{m}_std', 4)}"
                                for m in _METRICS) + " FROM met GROUP BY model", *_EVAL, full=True))
def cross_attack_summary(spark, sf):
    """Per detector: mean and sample std of each metric over attack types (4 decimals)."""
    return EV.cross_summary(metrics(spark, sf), "model", _METRICS)


@query("f1_pivot", "E13", O.sql(
    "SELECT model, " + ", ".join(O.r(f"max(f1_score) FILTER (WHERE attack_type = '{t}')", t)
                                 for t in schema.ATTACK_TYPES) + " FROM met GROUP BY model", *_EVAL, full=True))
def f1_pivot(spark, sf):
    """Detector x attack type F1 table."""
    return metrics(spark, sf).groupBy("model").pivot("attack_type", schema.ATTACK_TYPES).agg(F.max("f1_score"))


@query("best_model", "E14", O.sql(
    "SELECT attack_type, model, " + O.r("f1_score", "f1_score") + " FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
    "attack_type ORDER BY f1_score DESC, model) AS rk FROM met) WHERE rk = 1 UNION ALL SELECT 'overall', model, "
    + O.rx("f") + " FROM (SELECT model, avg(f1_score) AS f, ROW_NUMBER() OVER (ORDER BY avg(f1_score) DESC, model) AS rk "
    "FROM met GROUP BY model) WHERE rk = 1", *_EVAL, full=True))
def best_model(spark, sf):
    """Best detector per attack type and overall (highest mean F1)."""
    m = metrics(spark, sf)
    per = EV.best_by(m, ["attack_type"], "f1_score")
    overall = m.groupBy("model").agg(F.avg("f1_score").alias("f1_score")).withColumn("attack_type", F.lit("overall"))
    return per.unionByName(EV.best_by(overall, ["attack_type"], "f1_score"))


def _scored(spark, sf):
    f = ctx.full(spark, sf).filter(F.col("split") == "test")
    return f.select("attack_type", F.col("attack").alias("y"), F.col(SCORE).alias("score"))


_SC = ("sc AS (SELECT attack_type, " + SCORE + " AS score, COUNT(*) FILTER (WHERE attack = 1) AS pos, "
       "COUNT(*) FILTER (WHERE attack = 0) AS neg FROM features WHERE split = 'test' AND " + SCORE
       + " IS NOT NULL GROUP BY ALL)")


@query("roc_curve", "E7", O.sql(
    "SELECT attack_type, " + O.r("score", "threshold") + ", "
    + O.r("coalesce(cn / nullif(N, 0), 0)", "fpr") + ", " + O.r("coalesce(cp / nullif(P, 0), 0)", "tpr")
    + ", CAST(cp AS BIGINT) AS tp, CAST(cn AS BIGINT) AS fp FROM (SELECT *, SUM(pos) OVER w AS cp, SUM(neg) OVER w AS cn, "
    "SUM(pos) OVER (PARTITION BY attack_type) AS P, SUM(neg) OVER (PARTITION BY attack_type) AS N FROM sc "
    "WINDOW w AS (PARTITION BY attack_type ORDER BY score DESC ROWS UNBOUNDED PRECEDING))", _SC, full=True))
def roc_curve(spark, sf):
    """(fpr, tpr) at every distinct heartbeat-error threshold, per attack type (test)."""
    return EV.roc_curve(_scored(spark, sf), ["attack_type"])


_AUC = ("auc AS (SELECT attack_type, SUM(pos) AS P, SUM(neg) AS N, coalesce(SUM(pos * (coalesce(nb, 0) + 0.5 * neg)) "
        "/ nullif(SUM(pos) * SUM(neg), 0), 0) AS roc_auc FROM (SELECT *, SUM(neg) OVER (PARTITION BY attack_type "
        "ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb FROM sc) GROUP BY attack_type)")


@query("roc_auc", "E8", O.sql(
    "SELECT attack_type, CAST(P AS BIGINT) AS P, CAST(N AS BIGINT) AS N, " + O.r("roc_auc", "roc_auc") + " FROM auc",
    _SC, _AUC, full=True))
def roc_auc(spark, sf):
    """Area under the ROC curve (mid-rank formula) of the heartbeat error per attack type."""
    return EV.roc_auc(_scored(spark, sf), ["attack_type"])


_PR = ("pr AS (SELECT attack_type, score, coalesce(cp / nullif(cp + cn, 0), 0) AS precision, "
       "coalesce(cp / nullif(P, 0), 0) AS recall FROM (SELECT *, SUM(pos) OVER w AS cp, SUM(neg) OVER w AS cn, "
       "SUM(pos) OVER (PARTITION BY attack_type) AS P FROM sc WINDOW w AS (PARTITION BY attack_type "
       "ORDER BY score DESC ROWS UNBOUNDED PRECEDING)))")


@query("pr_curve_auc", "E9", O.sql(
    "SELECT attack_type, " + O.r("SUM((recall - coalesce(pr, 0.0)) * (precision + coalesce(pp, 1.0)) / 2)", "pr_auc")
    + " FROM (SELECT *, lag(recall) OVER w AS pr, lag(precision) OVER w AS pp FROM pr WINDOW w AS "
    "(PARTITION BY attack_type ORDER BY score DESC)) GROUP BY attack_type", _SC, _PR, full=True))
def pr_curve_auc(spark, sf):
    """Trapezoid area under the precision-recall curve of the heartbeat error per attack type."""
    pts = EV.pr_curve(_scored(spark, sf), ["attack_type"])
    return EV.pr_auc(pts, ["attack_type"])


@query("score_hist", "E10", O.sql(
    "SELECT attack, CAST(least(floor((x - lo) / (hi - lo) * 50), 49) AS BIGINT) AS bin, COUNT(*) AS n, "
    + O.rx("min(lo)") + " AS lo, " + O.rx("min(hi)") + " AS hi FROM (SELECT *, min(x) OVER (PARTITION BY attack) AS lo, "
    "max(x) OVER (PARTITION BY attack) AS hi FROM (SELECT CAST(attack AS BIGINT) AS attack, " + SCORE + " AS x "
    "FROM features WHERE split = 'test' AND " + SCORE + " IS NOT NULL)) GROUP BY ALL", full=True))
def score_hist(spark, sf):
    """50-bin histogram of the anomaly score by label."""
    from ..operators.stats import histogram
    f = ctx.full(spark, sf).filter(F.col("split") == "test")
    return histogram(f.select("attack", SCORE), SCORE, ["attack"])


def _avg4_sql(m: str) -> str:
    """Mean of 4-decimal values, rounded half-up to 4 decimals, in exact integer units."""
    s = f"SUM(CAST(round({O.rx(m, 4)} * 10000) AS BIGINT))"
    return f"floor((2 * {s} + COUNT(*)) / (2.0 * COUNT(*))) / 10000.0"


@query("average_row", "E16", O.sql(
    "SELECT upper(attack_type) AS attack_type, " + ", ".join(O.r(m, m, 4) for m in _METRICS + ["roc_auc"])
    + " FROM t16 UNION ALL SELECT 'AVERAGE', " + ", ".join(O.r(_avg4_sql(m), m, 4) for m in
                                                           _METRICS + ["roc_auc"]) + " FROM t16",
    *_EVAL, _SC, _AUC, "t16 AS (SELECT m.*, a.roc_auc FROM met m JOIN auc a USING (attack_type) "
    "WHERE model = 'heartbeat_rule')", full=True))
def average_row(spark, sf):
    """Per-attack table of the heartbeat detector (4 decimals) plus an AVERAGE row.

    The average of the 4-decimal values is taken in whole 1e-4 units and rounded
    half-up, so it does not depend on the order of a float sum.
    """
    m = metrics(spark, sf).filter(F.col("model") == "heartbeat_rule")
    a = EV.roc_auc(_scored(spark, sf), ["attack_type"]).select("attack_type", "roc_auc")
    cols = _METRICS + ["roc_auc"]
    t = m.join(a, on="attack_type").select(F.upper("attack_type").alias("attack_type"),
                                           *[rounded(F.round(c, 4)).alias(c) for c in cols])
    units = [F.sum(F.round(F.col(c) * 10000).cast("bigint")) for c in cols]
    n = F.count(F.lit(1))
    avg = t.agg(*[(F.floor((2 * u + n) / (2.0 * n)) / 10000.0).alias(c) for u, c in zip(units, cols)])
    return t.unionByName(avg.withColumn("attack_type", F.lit("AVERAGE")))


_BAL = ("bal AS (SELECT packet_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY attack_type ORDER BY "
        "md5(CAST(packet_id AS VARCHAR))) AS rn FROM typed WHERE split = 'test' AND attack = 1) WHERE rn <= "
        "(SELECT min(c) FROM (SELECT COUNT(*) AS c FROM typed WHERE split = 'test' AND attack = 1 GROUP BY attack_type)) "
        "UNION ALL SELECT packet_id FROM typed WHERE split = 'test' AND attack = 0)")


@query("imbalanced_vs_balanced", "E17", O.sql(
    "SELECT a.model, " + O.r("a.f", "f1_imbalanced") + ", " + O.r("b.f", "f1_balanced") + " FROM "
    "(SELECT model, " + _z("2 * COUNT(*) FILTER (WHERE y = 1 AND p = 1)", "2 * COUNT(*) FILTER (WHERE y = 1 AND p = 1) "
                           "+ COUNT(*) FILTER (WHERE y <> p)") + " AS f FROM preds GROUP BY model) a JOIN "
    "(SELECT model, " + _z("2 * COUNT(*) FILTER (WHERE y = 1 AND p = 1)", "2 * COUNT(*) FILTER (WHERE y = 1 AND p = 1) "
                           "+ COUNT(*) FILTER (WHERE y <> p)") + " AS f FROM preds WHERE packet_id IN (SELECT packet_id "
    "FROM bal) GROUP BY model) b USING (model)", _preds_sql(), _BAL, full=True))
def imbalanced_vs_balanced(spark, sf):
    """F1 of each detector on the whole test set and on the class-balanced test set."""
    p = rule_preds(spark, sf)
    bal = SA.balance_classes(ctx.typed(spark, sf).filter(F.col("split") == "test")).select("packet_id")
    a = EV.binary_metrics(p, ["model"]).select("model", F.col("f1_score").alias("f1_imbalanced"))
    b = EV.binary_metrics(p.join(bal, on="packet_id", how="left_semi"), ["model"]).select(
        "model", F.col("f1_score").alias("f1_balanced"))
    return a.join(b, on="model")


@query("run_ranking", "E18", O.sql(
    "SELECT metric, run, " + O.r("v", "value") + " FROM (SELECT 'f1_score' AS metric, attack_type || '/' || model AS run, "
    "f1_score AS v, ROW_NUMBER() OVER (ORDER BY f1_score DESC, attack_type || '/' || model) AS rk FROM met UNION ALL "
    "SELECT 'accuracy', attack_type || '/' || model, accuracy, ROW_NUMBER() OVER (ORDER BY accuracy DESC, "
    "attack_type || '/' || model) FROM met) WHERE rk = 1", *_EVAL, full=True))
def run_ranking(spark, sf):
    """Best run (attack type / detector) by F1 and by accuracy."""
    m = metrics(spark, sf).withColumn("run", F.concat_ws("/", "attack_type", "model"))
    out = []
    for metric in ("f1_score", "accuracy"):
        b = EV.best_by(m.withColumn("metric", F.lit(metric)), ["metric"], metric, name="run")
        out.append(b.select("metric", "run", F.col(metric).alias("value")))
    return out[0].unionByName(out[1])


@query("split_distribution", "E19", O.sql(
    "SELECT attack_type, COUNT(*) FILTER (WHERE split = 'train') AS train, COUNT(*) FILTER (WHERE split = 'test') "
    "AS test FROM typed GROUP BY attack_type"))
def split_distribution(spark, sf):
    """Train and test rows per attack type."""
    t = ctx.typed(spark, sf)
    return t.groupBy("attack_type").pivot("split", ["train", "test"]).count().fillna(0)


# ------------------------------------------------------------------ multi-class by rule signatures


def signature_frame(spark, sf, split: str):
    f = ctx.full(spark, sf).filter(F.col("split") == split)
    lab = F.create_map(*[x for i, c in enumerate(schema.CLASSES) for x in (F.lit(c), F.lit(i))])
    label = F.when(F.col("attack") == 0, F.lit("normal")).otherwise(F.lower("attack_type"))
    wide = f.select("packet_id", lab[label].alias("y"),
                    *[F.expr(e).cast("int").alias(m) for m, e in SIGNATURES.items()])
    return wide.unpivot(["packet_id", "y"], list(SIGNATURES), "model", "cluster")


def _sig_sql(split: str, name: str) -> str:
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT packet_id, {CLASS_CASE} AS y, '{m}' AS model, CAST({e} AS INT) AS cluster FROM features "
        f"WHERE split = '{split}'" for m, e in SIGNATURES.items()) + ")"


_CONT = "cont AS (SELECT model, cluster, y AS label, COUNT(*) AS n FROM trs GROUP BY ALL)"
_MAP = """
cl AS (SELECT DISTINCT model, cluster FROM cont),
perm AS (SELECT a.model, a.cluster AS c0, b.cluster AS c1, c.cluster AS c2, d.cluster AS c3, e.cluster AS c4
         FROM cl a JOIN cl b ON b.model = a.model AND b.cluster <> a.cluster
         JOIN cl c ON c.model = a.model AND c.cluster NOT IN (a.cluster, b.cluster)
         JOIN cl d ON d.model = a.model AND d.cluster NOT IN (a.cluster, b.cluster, c.cluster)
         JOIN cl e ON e.model = a.model AND e.cluster NOT IN (a.cluster, b.cluster, c.cluster, d.cluster)),
scored AS (SELECT p.*, """ + " + ".join(
    f"coalesce((SELECT n FROM cont x WHERE x.model = p.model AND x.cluster = p.c{j} AND x.label = {j}), 0)"
    for j in range(5)) + """ AS total FROM perm p),
best AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY total DESC, c0, c1, c2, c3, c4) AS rk
         FROM scored) WHERE rk = 1),
assigned AS (""" + " UNION ALL ".join(f"SELECT model, c{j} AS cluster, {j} AS mapped FROM best" for j in range(5)) + """),
mapping AS (SELECT * FROM assigned UNION ALL SELECT model, cluster, label FROM (SELECT *, ROW_NUMBER() OVER
            (PARTITION BY model, cluster ORDER BY n DESC, label) AS rk FROM cont
            WHERE (model, cluster) NOT IN (SELECT model, cluster FROM assigned)) WHERE rk = 1)"""
_K = [_sig_sql("train", "trs"), _sig_sql("test", "tes"), _CONT, _MAP]


def mapping(spark, sf):
    cont = CL.contingency(signature_frame(spark, sf, "train"), ["model"], "cluster", "y")
    return CL.cluster_to_class(cont, ["model"])


def multi_preds(spark, sf):
    test = signature_frame(spark, sf, "test")
    return CL.apply_mapping(test, mapping(spark, sf), ["model"], "cluster", "p")


@query("contingency", "K7", O.sql(
    "SELECT model, CAST(cluster AS BIGINT) AS cluster, CAST(label AS BIGINT) AS label, n FROM cont", *_K, full=True))
def contingency(spark, sf):
    """(rule-signature cluster, class) counts on the training split."""
    return CL.contingency(signature_frame(spark, sf, "train"), ["model"], "cluster", "y")


@query("cluster_to_class", "K8", O.sql("SELECT model, CAST(cluster AS BIGINT) AS cluster, CAST(mapped AS BIGINT) "
                                       "AS mapped FROM mapping",
                                       *_K, full=True))
def cluster_to_class(spark, sf):
    """Optimal one-to-one cluster -> class assignment (leftover clusters -> majority class)."""
    return mapping(spark, sf)


_PREDS_K = ("mp AS (SELECT t.packet_id, t.model, t.y, coalesce(m.mapped, -1) AS p FROM tes t LEFT JOIN mapping m "
            "ON t.model = m.model AND t.cluster = m.cluster)")


@query("apply_cluster_labels", "K9", O.sql("SELECT packet_id, model, CAST(p AS BIGINT) AS pred FROM mp",
                                           *_K, _PREDS_K, full=True))
def apply_cluster_labels(spark, sf):
    """Test rows labelled through the fitted map (unseen cluster -> -1)."""
    return multi_preds(spark, sf).select("packet_id", "model", F.col("p").alias("pred"))


@query("apply_mapping", "J6", O.sql(
    "SELECT model, CAST(p AS BIGINT) AS pred, COUNT(*) AS n FROM mp GROUP BY ALL", *_K, _PREDS_K, full=True))
def apply_mapping(spark, sf):
    """Broadcast left join of the cluster map; predictions counted per class (-1 = unmapped)."""
    return multi_preds(spark, sf).groupBy("model", F.col("p").alias("pred")).agg(F.count(F.lit(1)).alias("n"))


_CM = ("cm AS (SELECT g.model, g.y, g.p, coalesce(c.n, 0) AS n FROM (SELECT m.model, y.y, p.p FROM "
       "(SELECT DISTINCT model FROM mp) m, range(5) y(y), range(5) p(p)) g LEFT JOIN "
       "(SELECT model, y, p, COUNT(*) AS n FROM mp GROUP BY ALL) c ON g.model = c.model AND g.y = c.y AND g.p = c.p)")


@query("confusion_multi", "E4", O.sql(
    "SELECT model, y, p, n, " + O.r("coalesce(n / nullif(SUM(n) OVER (PARTITION BY model, y), 0), 0)", "row_share")
    + " FROM cm", *_K, _PREDS_K, _CM, full=True))
def confusion_multi(spark, sf):
    """5 x 5 confusion table per signature model, with empty cells and row shares."""
    return EV.confusion_multi(multi_preds(spark, sf), ["model"], len(schema.CLASSES))


_PC = ("pc AS (SELECT mo.model, k.k AS cls, COUNT(*) FILTER (WHERE mp.y = k.k AND mp.p = k.k) AS tp, "
       "COUNT(*) FILTER (WHERE mp.p = k.k) AS pp, COUNT(*) FILTER (WHERE mp.y = k.k) AS support FROM "
       "(SELECT DISTINCT model FROM mp) mo JOIN mp ON mp.model = mo.model, range(5) k(k) GROUP BY mo.model, k.k)")
_PCM = ("pcm AS (SELECT model, cls, " + _z("tp", "pp") + " AS precision, " + _z("tp", "support") + " AS recall, "
        + _z("2 * tp", "pp + support") + " AS f1, support, pp AS predicted FROM pc)")


@query("per_class_metrics", "E5", O.sql(
    "SELECT model, cls, " + ", ".join(O.r(c, c) for c in ("precision", "recall", "f1"))
    + ", support, predicted FROM pcm", *_K, _PREDS_K, _PC, _PCM, full=True))
def per_class_metrics(spark, sf):
    """Precision, recall, F1 and support of each class per signature model."""
    return EV.per_class_metrics(multi_preds(spark, sf), ["model"], range(len(schema.CLASSES)))


@query("classification_report", "E6", O.sql(
    "SELECT model, CAST(cls AS VARCHAR) AS row, " + ", ".join(O.r(c, c) for c in ("precision", "recall", "f1"))
    + ", " + O.r("support", "support") + " FROM pcm WHERE support > 0 OR predicted > 0 UNION ALL SELECT model, "
    "'macro avg', " + ", ".join(O.r(f"avg({c})", c) for c in ("precision", "recall", "f1")) + ", "
    + O.r("SUM(support)", "support") + " FROM pcm WHERE support > 0 OR predicted > 0 GROUP BY model UNION ALL "
    "SELECT model, 'weighted avg', " + ", ".join(O.r(_z(f"SUM({c} * support)", "SUM(support)"), c)
                                               for c in ("precision", "recall", "f1")) + ", "
    + O.r("SUM(support)", "support") + " FROM pcm WHERE support > 0 OR predicted > 0 GROUP BY model",
    *_K, _PREDS_K, _PC, _PCM, full=True))
def classification_report(spark, sf):
    """Per-class rows plus macro and weighted averages."""
    pc = EV.per_class_metrics(multi_preds(spark, sf), ["model"], range(len(schema.CLASSES)))
    return EV.classification_report(pc, ["model"])


@query("consistency", "E15", O.sql(
    "SELECT model, " + O.r("stddev_pop(f1)", "f1_std") + ", " + O.r("avg(f1)", "f1_mean") + ", "
    "CAST(ROW_NUMBER() OVER (ORDER BY " + O.rx("stddev_pop(f1)") + ", model) = 1 AS BIGINT) AS most_consistent "
    "FROM pcm GROUP BY model", *_K, _PREDS_K, _PC, _PCM, full=True))
def consistency(spark, sf):
    """Population std of each model's per-class F1; the smallest is the most consistent."""
    pc = EV.per_class_metrics(multi_preds(spark, sf), ["model"], range(len(schema.CLASSES)))
    g = pc.groupBy("model").agg(F.stddev_pop("f1").alias("f1_std"), F.avg("f1").alias("f1_mean"))
    w = Window.orderBy(rounded(F.col("f1_std")), F.col("model"))
    return g.withColumn("most_consistent", (F.row_number().over(w) == 1).cast("bigint"))


@query("minority_rule", "B6", O.sql(
    "SELECT model, CAST(pred AS BIGINT) AS pred, COUNT(*) AS n FROM (SELECT t.*, CASE WHEN g.k > 1 AND t.cluster = "
    "g.minority THEN 1 ELSE 0 END AS pred FROM tes t JOIN (SELECT model, COUNT(*) AS k, arg_min(cluster, "
    "n * 1000000 + cluster) AS minority FROM (SELECT model, cluster, COUNT(*) AS n FROM tes GROUP BY ALL) "
    "GROUP BY model) g USING (model)) GROUP BY ALL", _sig_sql("test", "tes"), full=True))
def minority_rule(spark, sf):
    """Least populated signature cluster flagged as attack (ties -> lowest id), counted per model."""
    t = signature_frame(spark, sf, "test")
    r = CL.minority_rule(t, ["model"], "cluster")
    return r.groupBy("model", "pred").agg(F.count(F.lit(1)).alias("n"))


CONTAMINATION = 0.1  # fixed value: default contamination of the detectors


@query("outlier_threshold", "B7", O.sql(
    "SELECT packet_id, CAST(rk > floor(n * (1 - 0.1)) AS BIGINT) AS flagged FROM (SELECT packet_id, "
    "ROW_NUMBER() OVER (ORDER BY " + SCORE + ", packet_id) AS rk, COUNT(*) OVER () AS n FROM features "
    "WHERE split = 'test' AND " + SCORE + " IS NOT NULL)", full=True))
def outlier_threshold(spark, sf):
    """Top share (contamination 0.1) of anomaly scores flagged; ties broken by id."""
    from ..operators.detect import top_share
    f = ctx.full(spark, sf).filter((F.col("split") == "test") & F.col(SCORE).isNotNull())
    return top_share(f, SCORE, CONTAMINATION).select("packet_id", "flagged")


# ------------------------------------------------------------------ graph


def _edges(spark, sf):
    return GR.edges(ctx.typed(spark, sf), ["attack"])


@query("edges", "R1", O.sql(
    "SELECT DISTINCT CAST(attack AS BIGINT) AS attack, source AS src, destination AS dst FROM typed "
    "WHERE source IS NOT NULL AND destination IS NOT NULL"))
def edges(spark, sf):
    """Distinct Source -> Destination edges per label."""
    return _edges(spark, sf)


_DEG = ("eg AS (SELECT DISTINCT attack, source AS src, destination AS dst "
        "FROM typed WHERE source IS NOT NULL AND destination IS NOT NULL), deg AS (SELECT attack, node, SUM(1) AS degree "
        "FROM (SELECT attack, src AS node FROM eg UNION ALL SELECT attack, dst FROM eg) GROUP BY ALL), cen AS (SELECT attack, node, degree, "
        "CASE WHEN COUNT(*) OVER (PARTITION BY attack) <= 1 THEN 1.0 ELSE degree / (COUNT(*) OVER (PARTITION BY "
        "attack) - 1) END AS centrality FROM deg)")


@query("degree_centrality", "R2", O.sql(
    "SELECT CAST(attack AS BIGINT) AS attack, node, CAST(degree AS BIGINT) AS degree, "
    + O.r("centrality", "centrality") + " FROM cen", _DEG))
def degree_centrality(spark, sf):
    """(in + out degree) / (nodes - 1) per node of the normal and the attack graph."""
    return GR.degree_centrality(_edges(spark, sf), ["attack"])


@query("centrality_change", "R3", O.sql(
    "SELECT coalesce(a.node, b.node) AS node, " + O.r("coalesce(a.centrality, 0)", "attack_centrality") + ", "
    + O.r("coalesce(b.centrality, 0)", "normal_centrality") + ", "
    + O.r("coalesce(a.centrality, 0) - coalesce(b.centrality, 0)", "centrality_change")
    + " FROM (SELECT * FROM cen WHERE attack = 1) a FULL OUTER JOIN (SELECT * FROM cen WHERE attack = 0) b "
    "ON a.node = b.node", _DEG))
def centrality_change(spark, sf):
    """Attack minus normal centrality per node (full outer join, missing -> 0)."""
    return GR.centrality_change(GR.degree_centrality(_edges(spark, sf), ["attack"]))


@query("centrality_join", "J4", O.sql(
    "SELECT COUNT(*) AS nodes, COUNT(*) FILTER (WHERE a.node IS NULL) AS normal_only, "
    "COUNT(*) FILTER (WHERE b.node IS NULL) AS attack_only FROM (SELECT * FROM cen WHERE attack = 1) a "
    "FULL OUTER JOIN (SELECT * FROM cen WHERE attack = 0) b ON a.node = b.node", _DEG))
def centrality_join(spark, sf):
    """Full outer join of the two centrality tables: matched and one-sided nodes."""
    c = GR.degree_centrality(_edges(spark, sf), ["attack"])
    a = c.filter(F.col("attack") == 1).select("node", F.lit(1).alias("in_a"))
    b = c.filter(F.col("attack") == 0).select("node", F.lit(1).alias("in_b"))
    j = a.join(b, on="node", how="full")
    return j.agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("in_a").isNull()).alias("normal_only"),
                 F.count_if(F.col("in_b").isNull()).alias("attack_only"))
