"""Detector scoring (E1-E19): metrics from counts, curves from per-score counts.

All metrics reduce (truth, prediction) rows with one aggregate per group; ROC
and PR curves first collapse rows to one row per distinct score, then take
skew-safe prefix sums in score order (never a global sort of the rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import stream


def _div(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def counts(pred: DataFrame, groups: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    yy, pp = F.col(y), F.col(p)
    return pred.groupBy(*groups).agg(
        F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
        F.count_if((yy == 0) & (pp == 0)).alias("tn"), F.count_if((yy == 1) & (pp == 0)).alias("fn"))


def binary_metrics(pred: DataFrame, groups: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """E1 (+E2): accuracy, precision, recall, F1 of class 1, macro and weighted F1."""
    c = counts(pred, groups, y, p)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    f1_pos = _div(2 * tp, 2 * tp + fp + fn)
    f1_neg = _div(2 * tn, 2 * tn + fn + fp)
    return c.select(
        *groups, "tp", "fp", "tn", "fn",
        _div(tp + tn, n).alias("accuracy"), _div(tp, tp + fp).alias("precision"),
        _div(tp, tp + fn).alias("recall"), f1_pos.alias("f1_score"),
        ((f1_pos + f1_neg) / 2).alias("f1_macro"),
        _div(f1_pos * (tp + fn) + f1_neg * (tn + fp), n).alias("f1_weighted"))


def confusion_binary(pred: DataFrame, groups: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """The dense 2 x 2 table with row shares."""
    c = counts(pred, groups, y, p)
    cells = F.array(*[F.struct(F.lit(a).alias("y"), F.lit(b).alias("p"), F.col(k).alias("n"))
                      for a, b, k in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    e = c.select(*groups, F.explode(cells).alias("c")).select(*groups, "c.*")
    return e.withColumn("row_share", _div(F.col("n"), F.sum("n").over(Window.partitionBy(*groups, "y"))))


def class_grid(spark, n_classes: int) -> DataFrame:
    """All (y, p) cells of an n x n confusion table (an explode, no join)."""
    r = F.sequence(F.lit(0), F.lit(n_classes - 1))
    return spark.range(1).select(F.explode(r).alias("y")).select("y", F.explode(r).alias("p"))


def confusion_multi(pred: DataFrame, groups: Sequence[str], n_classes: int, y: str = "y", p: str = "p") -> DataFrame:
    """N x n counts including empty cells, row-normalised (0/0 -> 0); predictions outside 0..n-1 ignored."""
    spark = pred.sparkSession
    got = pred.groupBy(*groups, F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    r = F.sequence(F.lit(0), F.lit(n_classes - 1))
    if groups:
        grid = got.select(*groups).distinct().select(*groups, F.explode(r).alias("y")).select(
            *groups, "y", F.explode(r).alias("p"))
    else:
        grid = class_grid(spark, n_classes)
    full = grid.join(got, on=[*groups, "y", "p"], how="left").fillna(0, subset=["n"])
    return full.withColumn("row_share", _div(F.col("n"), F.sum("n").over(Window.partitionBy(*groups, "y"))))


def per_class_metrics(pred: DataFrame, groups: Sequence[str], classes: Sequence[int],
                      y: str = "y", p: str = "p") -> DataFrame:
    """E5: precision, recall, F1 and support per class (sklearn semantics, zero_division=0)."""
    aggs = []
    for k in classes:
        aggs += [F.count_if((F.col(y) == k) & (F.col(p) == k)).alias(f"tp{k}"),
                 F.count_if(F.col(p) == k).alias(f"pp{k}"), F.count_if(F.col(y) == k).alias(f"s{k}")]
    c = pred.groupBy(*groups).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(k).alias("cls"), F.col(f"tp{k}").alias("tp"), F.col(f"pp{k}").alias("pp"),
                              F.col(f"s{k}").alias("support")) for k in classes])
    e = c.select(*groups, F.explode(rows).alias("r")).select(*groups, "r.*")
    prec = _div(F.col("tp"), F.col("pp"))
    rec = _div(F.col("tp"), F.col("support"))
    return e.select(*groups, "cls", prec.alias("precision"), rec.alias("recall"),
                    _div(2 * F.col("tp"), F.col("pp") + F.col("support")).alias("f1"), "support",
                    F.col("pp").alias("predicted"))


def classification_report(per_class: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per-class rows plus macro and weighted averages (classes seen in truth or prediction)."""
    pc = per_class.filter((F.col("support") > 0) | (F.col("predicted") > 0))
    base = pc.select(*groups, F.col("cls").cast("string").alias("row"), "precision", "recall", "f1",
                     F.col("support").cast("double").alias("support"))
    macro = pc.groupBy(*groups).agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                                    F.sum("support").cast("double").alias("support"))
    s = F.col("support")
    weighted = pc.groupBy(*groups).agg(
        F.lit("weighted avg").alias("row"), _div(F.sum(F.col("precision") * s), F.sum(s)).alias("precision"),
        _div(F.sum(F.col("recall") * s), F.sum(s)).alias("recall"), _div(F.sum(F.col("f1") * s), F.sum(s)).alias("f1"),
        F.sum(s).cast("double").alias("support"))
    return base.unionByName(macro).unionByName(weighted)


def score_counts(scored: DataFrame, groups: Sequence[str], score: str = "score", y: str = "y") -> DataFrame:
    """One row per (group, distinct score): positives and negatives at that score."""
    return scored.filter(F.col(score).isNotNull()).groupBy(*groups, F.col(score).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))


def roc_curve(scored: DataFrame, groups: Sequence[str], score: str = "score", y: str = "y") -> DataFrame:
    """(fpr, tpr) at every distinct score threshold (score >= threshold flagged); ``groups`` non-empty."""
    sc = score_counts(scored, groups, score, y).withColumn("_neg_score", -F.col("score"))
    tot = sc.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    seg = stream.segment_by_key(sc, groups, "_neg_score") if groups else stream.segmented(sc, [], "_neg_score")
    cum = stream.prefix_sums(seg, list(groups), [F.col("_neg_score")], ["pos", "neg"])
    cum = cum.join(F.broadcast(tot), on=list(groups))
    return cum.select(*groups, F.col("score").alias("threshold"),
                      _div(F.col("neg_before") + F.col("neg"), F.col("N")).alias("fpr"),
                      _div(F.col("pos_before") + F.col("pos"), F.col("P")).alias("tpr"),
                      (F.col("pos_before") + F.col("pos")).alias("tp"), (F.col("neg_before") + F.col("neg")).alias("fp"))


def roc_auc(scored: DataFrame, groups: Sequence[str], score: str = "score", y: str = "y") -> DataFrame:
    """AUC by the mid-rank formula (ties count one half); 0 when a class is missing."""
    sc = score_counts(scored, groups, score, y)
    seg = stream.segment_by_key(sc, groups, "score") if groups else stream.segmented(sc, [], "score")
    cum = stream.prefix_sums(seg, list(groups), [F.col("score")], ["neg"])
    # each positive beats the negatives below it and ties half of those at its score
    g = cum.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                                 F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))).alias("wins"))
    return g.select(*groups, "P", "N", _div(F.col("wins"), F.col("P") * F.col("N")).alias("roc_auc"))


def pr_curve(scored: DataFrame, groups: Sequence[str], score: str = "score", y: str = "y") -> DataFrame:
    """E9 points: precision and recall at every distinct threshold, plus the trapezoid area per group."""
    roc = roc_curve(scored, groups, score, y)
    tot = score_counts(scored, groups, score, y).groupBy(*groups).agg(F.sum("pos").alias("P"))
    pts = roc.join(F.broadcast(tot), on=list(groups)) if groups else roc
    pts = pts.select(*groups, "threshold", _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                     _div(F.col("tp"), F.col("P")).alias("recall"))
    return pts


def pr_auc(points: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Trapezoid area under (recall, precision), starting at (0, 1), thresholds descending."""
    pts = points.withColumn("_t", -F.col("threshold"))
    seg = stream.segment_by_key(pts, groups, "_t") if groups else stream.segmented(pts, [], "_t")

    def build(d, w):
        return d.withColumn("_pr", F.lag("recall").over(w)).withColumn("_pp", F.lag("precision").over(w))
    s = stream.windowed(seg, list(groups), [F.col("_t")], build, 1)
    pr = F.coalesce(F.col("_pr"), F.lit(0.0))
    pp = F.coalesce(F.col("_pp"), F.lit(1.0))
    return s.groupBy(*groups).agg(F.sum((F.col("recall") - pr) * (F.col("precision") + pp) / 2).alias("pr_auc"))


def cross_summary(table: DataFrame, by: str, metrics: Sequence[str], digits: int = 4) -> DataFrame:
    """Mean and sample std of each metric per ``by``, rounded."""
    aggs = []
    for m in metrics:
        aggs += [F.round(F.avg(m), digits).alias(f"{m}_mean"), F.round(F.stddev_samp(m), digits).alias(f"{m}_std")]
    return table.groupBy(by).agg(*aggs)


def best_by(table: DataFrame, groups: Sequence[str], metric: str, name: str = "model") -> DataFrame:
    """The row with the largest metric per group (ties -> smallest name)."""
    best = F.min_by(F.struct(F.col(name), F.col(metric)), F.struct((-F.col(metric)).alias("k"), F.col(name)))
    return table.groupBy(*groups).agg(best.alias("b")).select(*groups, "b.*")
