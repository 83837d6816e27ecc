"""Aggregations, statistics and profiles.

Everything reduces with partial (map-side) aggregation; per-feature results
come from one wide ``agg`` or from a long (unpivoted) frame that is consumed by
aggregates directly.  Only tables bounded by features x classes reach the
driver (to build the next expressions), as in any ``ml`` fit.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions.numeric import EPS
from ..functions.quantiles import exact_quantiles
from . import gram, stream

# Fixed values.
MIN_NONNULL_SHARE = 0.5      # drop features with fewer non-null values
HIST_BINS = 50               # histogram bins
GAP_QUANTILE = 0.99          # gaps at or above this quantile are dropped
LOG_BINS_ABOVE = 1000.0      # log-spaced bins when the maximum exceeds this
EASY_ABOVE = 5.0             # separability thresholds
MEDIUM_ABOVE = 2.0
SIGNIFICANCE = 0.01
SIGNATURE_FEATURES = [
    "inter_arrival", "msg_rate", "byte_rate", "ttl_violation", "sqNum_jump", "stNum_change",
    "heartbeat_interval_error", "heartbeat_within_tol", "sq_reset_violation", "t_st_consistency_violation",
    "status_change_missing_on_event", "status_change_violation_on_heartbeat",
]


def dbl(c: str) -> Column:
    return F.col(f"`{c}`").cast("double")


def long_values(df: DataFrame, features: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids..., feature, value) with nulls kept."""
    d = df.select(*ids, *[dbl(c).alias(c) for c in features])
    return d.unpivot(list(ids), list(features), "feature", "value")


# ------------------------------------------------------------------ S8


def validate_counts(labelled: DataFrame, expected: Mapping[str, Mapping[str, int]]) -> DataFrame:
    spark = labelled.sparkSession
    exp = spark.createDataFrame([(s, c, int(n)) for s, d in expected.items() for c, n in d.items()],
                                "split string, label string, expected bigint")
    got = labelled.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
    j = got.join(F.broadcast(exp), on=["split", "label"], how="full")
    n = F.coalesce(F.col("n"), F.lit(0))
    return j.select(
        "split", "label", n.alias("n"), "expected",
        (n == F.coalesce(F.col("expected"), F.lit(-1))).cast("bigint").alias("matches"),
        (100.0 * n / F.sum(n).over(Window.partitionBy("split"))).alias("pct"))


# ------------------------------------------------------------------ M2-M5


def feature_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature: rows, non-null count, share, exact median (long frame, no row shuffle)."""
    long = long_values(df, features)
    counts = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("nonnull"))
    med = exact_quantiles(long, "value", ["feature"], [0.5], prefix="median")
    return (counts.join(med, on="feature", how="left")
            .withColumnRenamed("median0", "median")
            .withColumn("share", F.col("nonnull") / F.col("n")))


def nonnull_shares(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """M2's input: rows, non-null count and share of every feature, from one wide aggregate."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(dbl(c)).alias(c) for c in features])
    rows = counts.unpivot(["_n"], list(features), "feature", "nonnull")
    return rows.select("feature", F.col("_n").alias("n"), "nonnull", F.try_divide(F.col("nonnull"), F.col("_n")).alias("share"))


def drop_sparse(profile: DataFrame, strict: bool = False, always_keep: Sequence[str] = ()) -> list[str]:
    """M2: features whose non-null share is >= 0.5 (characterisation) or > 0.5 (detection)."""
    cond = F.col("share") > MIN_NONNULL_SHARE if strict else F.col("share") >= MIN_NONNULL_SHARE
    if always_keep:
        cond = cond | F.col("feature").isin(*always_keep)
    return [r["feature"] for r in profile.filter(cond).select("feature").collect()]


def impute(df: DataFrame, medians: Mapping[str, float | None], features: Sequence[str]) -> DataFrame:
    """M3: nulls -> train median (0 when the median itself is missing)."""
    keep = [c for c in df.columns if c not in features]
    fills = [F.coalesce(dbl(c), F.lit(float(medians.get(c) if medians.get(c) is not None else 0.0))).alias(c)
             for c in features]
    return df.select(*keep, *fills)


def variances(df: DataFrame, features: Sequence[str]) -> dict[str, float | None]:
    """Sample variance per feature; exactly 0.0 when the column is constant.

    Merged partial variances of a constant column come out as ~1e-33 rather
    than 0, so constancy is decided by min == max, which is exact.
    """
    if not features:
        return {}
    row = df.agg(*[a for c in features for a in _spread(c)]).collect()[0]
    return {c: _variance(row, c) for c in features}


def _spread(c: str) -> list[Column]:
    return [F.var_samp(dbl(c)).alias(f"v__{c}"), (F.max(dbl(c)) > F.min(dbl(c))).alias(f"d__{c}")]


def _variance(row: Row, c: str) -> float | None:
    return row[f"v__{c}"] if row[f"d__{c}"] else (0.0 if row[f"v__{c}"] is not None else None)


def variances_and_moments(df: DataFrame, features: Sequence[str]) -> tuple[dict[str, float | None], dict[str, tuple[float, float]]]:
    """``variances`` and ``moments`` of the same features from one wide aggregate."""
    if not features:
        return {}, {}
    aggs = []
    for c in features:
        aggs += [*_spread(c), F.avg(dbl(c)).alias(f"m__{c}"), F.stddev_pop(dbl(c)).alias(f"s__{c}")]
    row = df.agg(*aggs).collect()[0]
    return {c: _variance(row, c) for c in features}, {c: (row[f"m__{c}"], row[f"s__{c}"]) for c in features}


def moments(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per feature (one wide aggregate)."""
    aggs = []
    for c in features:
        aggs += [F.avg(dbl(c)).alias(f"m__{c}"), F.stddev_pop(dbl(c)).alias(f"s__{c}")]
    row = df.agg(*aggs).collect()[0]
    return {c: (row[f"m__{c}"], row[f"s__{c}"]) for c in features}


def standardize(df: DataFrame, mom: Mapping[str, tuple[float, float]], features: Sequence[str]) -> DataFrame:
    """M5: z-score with population std; non-finite results (zero std) -> 0."""
    keep = [c for c in df.columns if c not in features]
    zs = []
    for c in features:
        m, s = mom[c]
        m = 0.0 if m is None else float(m)
        if s is not None and s <= 1e-12 * max(1.0, abs(m)):
            s = 0.0  # a constant column: its merged std is float noise, not spread
        z = F.try_divide(dbl(c) - F.lit(m), F.lit(float(s)) if s else F.lit(0.0))
        zs.append(F.coalesce(F.when(~F.isnan(z), z), F.lit(0.0)).alias(c))
    return df.select(*keep, *zs)


def collected(prof: DataFrame) -> DataFrame:
    """A profile (one row per feature) computed once and read again from the driver."""
    return prof.sparkSession.createDataFrame(prof.collect(), prof.schema)


def prepare(train: DataFrame, features: Sequence[str], strict: bool = False,
            always_keep: Sequence[str] = (), scale: bool = True) -> tuple[list[str], dict, dict]:
    """M2 -> M3 -> M4 (-> M5 moments) fitted on ``train``.

    Returns (kept features, medians, moments).  Apply with ``impute`` then
    ``standardize`` to any frame (train or test).
    """
    prof = collected(feature_profile(train, features))
    kept = drop_sparse(prof, strict=strict, always_keep=always_keep)
    kept = [c for c in features if c in kept]
    medians = {r["feature"]: r["median"] for r in prof.select("feature", "median").collect()}
    filled = impute(train, medians, kept)
    var, mom = variances_and_moments(filled, kept)
    kept = [c for c in kept if var[c] is not None and var[c] > 0]
    return kept, medians, {c: mom[c] for c in kept} if scale else {}


def clean_matrix(df: DataFrame, kept: Sequence[str], medians: Mapping, mom: Mapping) -> DataFrame:
    out = impute(df, medians, kept)
    return standardize(out, mom, kept) if mom else out


# ------------------------------------------------------------------ A1-A4


def overall_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(F.col("attack") == 0).alias("normal"),
                  F.count_if(F.col("attack") == 1).alias("attacks"),
                  F.avg(F.col("attack").cast("double")).alias("attack_ratio"))


def attack_dist(df: DataFrame) -> DataFrame:
    p = df.groupBy("attack_type").pivot("attack", [0, 1]).agg(F.count(F.lit(1))).fillna(0)
    return p.select("attack_type", F.col("0").alias("n_normal"), F.col("1").alias("n_attack"))


def device_counts(df: DataFrame) -> DataFrame:
    per = df.groupBy("gocb_ref").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct("gocb_ref", "n"), F.struct((-F.col("n")).alias("k"), F.col("gocb_ref")))
    return per.agg(F.count(F.lit(1)).alias("n_devices"), best.alias("b")).select(
        "n_devices", F.col("b.gocb_ref").alias("top_device"), F.col("b.n").alias("top_count"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: count, mean, std, min, quartiles, max per numeric column (long output)."""
    long = long_values(df, columns)
    agg = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", ["feature"], [0.25, 0.5, 0.75], prefix="q")
    return agg.join(q, on="feature", how="left").select(
        "feature", "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
        F.col("q2").alias("p75"), "max")


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4 for every other column: count, distinct values, the most frequent one and its count.

    Values are compared by their text form; of equally frequent ones the smallest is the top.
    Rows are counted per (column, value) with a map-side combine, then each task's best value
    per column goes on, so a column of unique values never meets in one task.  Nulls do not
    count; a column without values has count and unique 0.
    """
    d = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    counts = d.unpivot([], list(columns), "feature", "value").groupBy("feature", "value").agg(
        F.count("value").alias("c"))
    seen = F.col("value").isNotNull()
    best = F.min(F.when(seen, F.struct((-F.col("c")).alias("c"), F.col("value")))).alias("best")
    return counts.groupBy("feature").agg(
        F.sum("c").alias("count"), F.count("value").alias("unique"), best).select(
        "feature", "count", "unique", F.col("best.value").alias("top"), (-F.col("best.c")).alias("freq"))


def describe_columns(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """A4 whole: one row per column; numbers have no top, other columns no moments."""
    none = lambda names, t: [F.lit(None).cast(t).alias(n) for n in names]
    nums = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    a = describe(df, numeric).select("feature", "count", *none(["unique"], "bigint"), *none(["top"], "string"),
                                     *none(["freq"], "bigint"), *nums)
    b = describe_text(df, text).select("*", *none(nums, "double"))
    return a.unionByName(b)


# ------------------------------------------------------------------ A5 / A6


def mann_whitney(df: DataFrame, features: Sequence[str], group: str = "attack_type",
                 label: str = "attack") -> DataFrame:
    """Two-sided Mann-Whitney U per (group, feature): normal (label 0) vs attack (label 1).

    Ties get mid-ranks; the normal approximation uses the tie correction and a
    0.5 continuity correction.  Ranks come from per-value counts and a
    skew-safe prefix sum over value segments, never from a per-group sort of rows.
    """
    long = long_values(df, features, [group, label]).filter(F.col("value").isNotNull())
    long = long.filter(~F.isnan("value"))
    per_value = long.groupBy(group, "feature", "value").agg(
        F.count(F.lit(1)).alias("c"), F.count_if(F.col(label) == 0).alias("c0"))
    seg = stream.segment_by_key(per_value, [group, "feature"], "value")
    ranked = stream.prefix_sums(seg, [group, "feature"], [F.col("value")], ["c"])
    mid = F.col("c_before") + (F.col("c") + 1) / 2.0
    g = ranked.groupBy(group, "feature").agg(
        F.sum("c0").alias("n0"), (F.sum("c") - F.sum("c0")).alias("n1"),
        F.sum(F.col("c0") * mid).alias("r0"),
        F.sum(F.col("c").cast("double") ** 3 - F.col("c")).alias("ties"))
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    n = n0 + n1
    u0 = F.col("r0") - n0 * (n0 + 1) / 2.0
    mu = n0 * n1 / 2.0
    sigma = F.sqrt(n0 * n1 / 12.0 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    u_big = F.greatest(u0, n0 * n1 - u0)
    z = F.try_divide(u_big - mu - 0.5, sigma)
    return g.filter((F.col("n0") > 0) & (F.col("n1") > 0)).select(
        group, "feature", F.col("n0"), F.col("n1"), u0.alias("u"), z.alias("z"),
        F.least(F.lit(1.0), 2.0 * normal_sf(z)).alias("p_value"))


def normal_sf(z: Column) -> Column:
    """Upper tail of the standard normal: erfc(z / sqrt 2) / 2."""
    x = F.abs(z) / math.sqrt(2.0)
    return F.when(z.isNull(), None).when(z >= 0, 0.5 * erfc(x)).otherwise(1.0 - 0.5 * erfc(x))


# Coefficients of the rational approximation of erfc (Numerical Recipes erfcc, Chebyshev).
_ERFC_COEF = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
              0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def erfc(x: Column) -> Column:
    """erfc for x >= 0 (fractional error < 1.2e-7)."""
    t = 1.0 / (1.0 + 0.5 * x)
    poly = F.lit(_ERFC_COEF[-1])
    for c in reversed(_ERFC_COEF[:-1]):
        poly = poly * t + F.lit(c)
    return t * F.exp(-x * x + poly)


def feature_stats(df: DataFrame, features: Sequence[str], group: str = "attack_type") -> DataFrame:
    """A5: per (group, feature) means / sample stds by label, |mean diff|, p-value, p < 0.01."""
    long = long_values(df, features, [group, "attack"]).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    v = F.col("value")
    a = long.groupBy(group, "feature").agg(
        F.avg(F.when(F.col("attack") == 0, v)).alias("normal_mean"),
        F.stddev_samp(F.when(F.col("attack") == 0, v)).alias("normal_std"),
        F.avg(F.when(F.col("attack") == 1, v)).alias("attack_mean"),
        F.stddev_samp(F.when(F.col("attack") == 1, v)).alias("attack_std"))
    mw = mann_whitney(df, features, group)
    return a.join(mw.select(group, "feature", "p_value"), on=[group, "feature"], how="inner").select(
        group, "feature", "normal_mean", "normal_std", "attack_mean", "attack_std",
        F.abs(F.col("attack_mean") - F.col("normal_mean")).alias("mean_difference"), "p_value",
        (F.col("p_value") < SIGNIFICANCE).cast("bigint").alias("significant"))


# ------------------------------------------------------------------ A7-A12


def attack_signatures(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per attack type, sizes and the mean of each feature by label."""
    aggs = [F.count(F.lit(1)).alias("num_samples"), F.count_if(F.col("attack") == 1).alias("num_attack")]
    for c in features:
        aggs += [F.avg(F.when(F.col("attack") == 0, dbl(c))).alias(f"{c}_mean_normal"),
                 F.avg(F.when(F.col("attack") == 1, dbl(c))).alias(f"{c}_mean_attack")]
    out = df.groupBy("attack_type").agg(*aggs)
    return out.withColumn("attack_ratio", F.col("num_attack") / F.greatest(F.col("num_samples"), F.lit(1)))


def separability(z: DataFrame, features: Sequence[str], by_label: bool = True) -> DataFrame:
    """A8 on a standardized frame: centroid distance, mean population variance, score, class."""
    long = long_values(z, features, ["attack_type", "attack"])
    per = long.groupBy("attack_type", "feature").agg(
        F.avg(F.when(F.col("attack") == 1, F.col("value"))).alias("ma"),
        F.avg(F.when(F.col("attack") == 0, F.col("value"))).alias("mn"),
        F.var_pop(F.when(F.col("attack") == 1, F.col("value"))).alias("va"),
        F.var_pop(F.when(F.col("attack") == 0, F.col("value"))).alias("vn"),
        F.count_if(F.col("attack") == 1).alias("na"), F.count_if(F.col("attack") == 0).alias("nn"))
    t = per.groupBy("attack_type").agg(
        F.sqrt(F.sum((F.col("ma") - F.col("mn")) ** 2)).alias("inter_class_distance"),
        ((F.avg("va") + F.avg("vn")) / 2).alias("intra_class_variance"),
        F.min("na").alias("na"), F.min("nn").alias("nn"))
    score = F.try_divide(F.col("inter_class_distance"), F.sqrt("intra_class_variance") + EPS)
    return t.filter((F.col("na") > 0) & (F.col("nn") > 0)).select(
        F.initcap("attack_type").alias("attack_type"), "inter_class_distance", "intra_class_variance",
        score.alias("separability_score"),
        F.when(score > EASY_ABOVE, "Easy").when(score > MEDIUM_ABOVE, "Medium").otherwise("Hard")
        .alias("detection_difficulty"))


def variance_rank(filled: DataFrame, features: Sequence[str]) -> DataFrame:
    """Sample variance per feature with a dense rank (descending)."""
    long = long_values(filled, features)
    from ..plans.registry import rounded
    v = long.groupBy("feature").agg(F.var_samp("value").alias("variance"))
    # rank on the rounded value: equal variances that differ in the last bits tie
    return v.withColumn("variance_rank", F.dense_rank().over(Window.orderBy(rounded(F.col("variance")).desc())))


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; null when a side is constant (ANSI-safe)."""
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def corr_with_label(df: DataFrame, features: Sequence[str], label: str = "attack") -> DataFrame:
    """Correlation of each feature with the label (long output)."""
    long = long_values(df, features, [label])
    return long.groupBy("feature").agg(pearson(F.col("value"), F.col(label).cast("double")).alias("corr"))


def corr_delta(df: DataFrame, features: Sequence[str], label: str = "attack") -> DataFrame:
    """Correlation of each feature pair in attack rows minus that in normal rows.

    Per label, features with fewer than half of their values go (the share rounded down) and
    gaps (null, NaN, infinite) take the label's median; pairs need both features in both labels.  Correlations are
    cut to [-1, 1]; pairs with a constant side in either label have no row.
    """
    df = df.select(label, *[gram.finite(c).alias(c) for c in features])
    fills, usable = {}, set(features)
    for lab in (0, 1):
        prof = feature_profile(df.filter(F.col(label) == lab), features).collect()
        usable &= {r["feature"] for r in prof if r["nonnull"] >= int(r["n"] * MIN_NONNULL_SHARE)}
        fills[lab] = {r["feature"]: r["median"] for r in prof}
    kept = [c for c in features if c in usable]
    is_attack = F.col(label) == 1
    filled = df.filter(F.col(label).isin(0, 1)).select(is_attack.alias("_attack"), *[
        F.coalesce(F.col(f"`{c}`"), F.when(is_attack, F.lit(fills[1][c])).otherwise(F.lit(fills[0][c]))).alias(c)
        for c in kept])
    c = gram.correlations(filled, kept, ["_attack"])
    cut = F.least(F.greatest("corr", F.lit(-1.0)), F.lit(1.0))
    by_label = c.filter("corr is not null").groupBy("fa", "fb").agg(
        F.max(F.when(F.col("_attack"), cut)).alias("c1"), F.max(F.when(~F.col("_attack"), cut)).alias("c0"))
    return by_label.filter("c0 is not null and c1 is not null").select(
        F.col("fa").alias("feature_a"), F.col("fb").alias("feature_b"),
        (F.col("c1") - F.col("c0")).alias("corr_delta"))


# ------------------------------------------------------------------ A13-A26 (EDA, train split)


def hour_profile(df: DataFrame) -> DataFrame:
    ts = F.col("t").cast("string").try_cast("timestamp")
    return (df.select(F.hour(ts).alias("hour"), F.weekday(ts).alias("dayofweek"), "attack")
            .groupBy("hour", "dayofweek", "attack").agg(F.count(F.lit(1)).alias("n")))


def attack_by_hour(df: DataFrame) -> DataFrame:
    ts = F.col("t").cast("string").try_cast("timestamp")
    a = df.filter(F.col("attack") == 1).select("attack_type", F.hour(ts).alias("hour"))
    p = a.groupBy("attack_type").pivot("hour", list(range(24))).agg(F.count(F.lit(1))).fillna(0)
    return p.select("attack_type", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def top_devices(df: DataFrame, k: int = 10) -> DataFrame:
    """Top-k devices by row count (ties by name) - a k-row table."""
    per = df.groupBy("gocb_ref").agg(F.count(F.lit(1)).alias("n"))
    return per.orderBy(F.desc("n"), F.asc("gocb_ref")).limit(k)


def device_attack_pct(df: DataFrame, k: int = 10) -> DataFrame:
    """Share of normal / attack rows for the k busiest devices (semi-join J5)."""
    top = top_devices(df, k).select("gocb_ref")
    sub = df.join(F.broadcast(top), on="gocb_ref", how="left_semi")
    g = sub.groupBy("gocb_ref").agg(F.count(F.lit(1)).alias("n"),
                                     F.count_if(F.col("attack") == 0).alias("n0"))
    return g.select("gocb_ref", (100.0 * F.col("n0") / F.col("n")).alias("pct_normal"),
                    (100.0 * (F.col("n") - F.col("n0")) / F.col("n")).alias("pct_attack"))


def attack_by_device(df: DataFrame, k: int = 10) -> DataFrame:
    """Attack rows per device x type for the k devices with most attacks."""
    a = df.filter(F.col("attack") == 1)
    p = a.groupBy("gocb_ref").pivot("attack_type", schema.ATTACK_TYPES).agg(F.count(F.lit(1))).fillna(0)
    total = sum(F.col(t) for t in schema.ATTACK_TYPES)
    return p.withColumn("total", total).orderBy(F.desc("total"), F.asc("gocb_ref")).limit(k)


def _stream_build_lag(col: str, out: str):
    def build(d: DataFrame, w) -> DataFrame:
        return d.withColumn(out, F.lag(F.col(col)).over(w)).withColumn(
            f"{out}_first", F.lag(F.lit(1)).over(w).isNull())
    return build


def bool_change_rate(df: DataFrame) -> DataFrame:
    """% of rows whose raw flag text differs from the device's previous row (first row counts)."""
    s = stream.segmented(df, ["gocb_ref"], "time_s")
    order = [F.col("time_s").asc_nulls_last(), F.col("packet_id")]
    s = stream.windowed(s, ["gocb_ref"], order, _stream_build_lag("boolean_raw", "_prev"), 1)
    changed = F.coalesce(F.col("boolean_raw") != F.col("_prev"), F.lit(True))
    return s.groupBy("attack_type", "attack").agg((100.0 * F.avg(changed.cast("double"))).alias("change_pct"))


def bool_true_hist(df: DataFrame) -> DataFrame:
    """Occurrences of 'True' (case-sensitive) per row, counted by label."""
    k = F.coalesce(F.regexp_count(F.coalesce(F.col("boolean_raw"), F.lit("nan")), F.lit("True")), F.lit(0))
    return df.groupBy(k.alias("true_count"), "attack").agg(F.count(F.lit(1)).alias("n"))


def global_gaps(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Time gap to the previous row of each key in time order (skew-safe)."""
    s = stream.segmented(df, list(keys), "time_s")
    order = [F.col("time_s").asc_nulls_last(), F.col("packet_id")]
    s = stream.windowed(s, list(keys), order, _stream_build_lag("time_s", "_prev_t"), 1)
    return s.withColumn("gap", F.col("time_s") - F.col("_prev_t"))


def histogram(df: DataFrame, value: str, groups: Sequence[str], bins: int = HIST_BINS,
              log_above: float | None = None) -> DataFrame:
    """Equal-width bins over [min, max] per group (last edge closed); optional log10 bins."""
    groups = list(groups)
    whole = not groups
    if whole:
        df, groups = df.withColumn("_all", F.lit(0)), ["_all"]
    v = dbl(value)
    if log_above is not None:
        mx = df.groupBy(*groups).agg(F.max(v).alias("_mx"))
        d = df.join(F.broadcast(mx), on=groups, how="left")
        use_log = F.col("_mx") > log_above
        v = F.when(use_log, F.when(v > 0, F.log10(v))).otherwise(v)
        df = d
    d = df.select(*groups, v.alias("_x")).filter(F.col("_x").isNotNull())
    rng = d.groupBy(*groups).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    d = d.join(F.broadcast(rng), on=groups, how="inner")
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width <= 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / width * bins), F.lit(bins - 1))).cast("bigint")
    out = d.groupBy(*groups, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"),
                                                  F.first("_lo").alias("lo"), F.first("_hi").alias("hi"))
    return out.drop("_all") if whole else out


def histograms(df: DataFrame, features: Sequence[str], groups: Sequence[str], bins: int = HIST_BINS,
               log_above: float | None = None) -> DataFrame:
    """``histogram`` of every feature, as (feature, groups, bin, n, lo, hi); rows meet their bins before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), dbl(f).alias("_v")) for f in features])
    long = df.select(*groups, F.inline(pairs)).filter(F.col("_v").isNotNull())
    return histogram(long, "_v", ["feature", *groups], bins, log_above)


def gap_hist(df: DataFrame, by_label: bool = False) -> DataFrame:
    """Gaps in each attack type's time order (per label if asked), below the 99 % quantile, 50 bins."""
    keys = ["attack_type", "attack"] if by_label else ["attack_type"]
    g = global_gaps(df, keys).filter(F.col("gap").isNotNull())
    q = exact_quantiles(g, "gap", keys, [GAP_QUANTILE], prefix="_q")
    kept = g.join(F.broadcast(q), on=keys).filter(F.col("gap") < F.col("_q0"))
    return histogram(kept, "gap", keys)


def interval_vs_ttl(df: DataFrame) -> DataFrame:
    """Expected (TTL / 2) vs actual device gap, complete rows only."""
    s = stream.segmented(df, ["gocb_ref"], "time_s")
    order = [F.col("time_s").asc_nulls_last(), F.col("packet_id")]
    s = stream.windowed(s, ["gocb_ref"], order, _stream_build_lag("time_s", "_prev_t"), 1)
    out = s.select("packet_id", "attack", (F.col("time_s") - F.col("_prev_t")).alias("actual_interval"),
                   (F.col("ttl_ms") / 2000.0).alias("expected_interval"))
    return out.dropna(subset=["actual_interval", "expected_interval", "attack"])


def _state_changes(df: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with the state before them in their attack type's time order, and whether it changed (first row: yes)."""
    s = stream.segmented(df, ["attack_type"], "time_s")
    order = [F.col("time_s").asc_nulls_last(), F.col("packet_id")]
    s = stream.windowed(s, ["attack_type"], order, _stream_build_lag("st_num", "_prev_st"), 1)
    return s, F.coalesce(F.col("st_num") != F.col("_prev_st"), F.lit(True))


def event_messages(df: DataFrame) -> DataFrame:
    """Class of every message on the timeline: heartbeat, event, attack or event_attack."""
    s, ev = _state_changes(df)
    hit = F.col("attack") == 1
    kind = (F.when(ev & hit, "event_attack").when(hit, "attack").when(ev, "event").otherwise("heartbeat"))
    return s.select("packet_id", "attack_type", kind.alias("kind"))


def event_timeline(df: DataFrame) -> DataFrame:
    """Per attack type in time order: messages, state changes (first row counts), attacks, both."""
    s, ev = _state_changes(df)
    return s.groupBy("attack_type").agg(
        F.count(F.lit(1)).alias("total_msgs"), F.count_if(ev).alias("total_events"),
        F.count_if(F.col("attack") == 1).alias("total_attacks"),
        F.count_if(ev & (F.col("attack") == 1)).alias("events_with_attacks"))


def state_evolution(df: DataFrame, n: int = 1000) -> DataFrame:
    """stNum by message index for the first ``n`` rows of each attack type (file order)."""
    order = Window.partitionBy("attack_type").orderBy("packet_id")  # Spark cuts each task's part to n rows first
    p = df.select("attack_type", "packet_id", "st_num").withColumn("msg_index", F.row_number().over(order) - 1)
    return p.filter(F.col("msg_index") < n).select("attack_type", "msg_index", "st_num")


def device_events(df: DataFrame) -> DataFrame:
    """Per (attack_type, device): messages, state changes (first row counts), attacks during changes."""
    s = stream.segmented(df, ["attack_type", "gocb_ref"], "time_s")
    order = [F.col("time_s").asc_nulls_last(), F.col("packet_id")]
    s = stream.windowed(s, ["attack_type", "gocb_ref"], order, _stream_build_lag("st_num", "_prev_st"), 1)
    ev = F.coalesce(F.col("st_num") != F.col("_prev_st"), F.lit(True))
    return s.groupBy("attack_type", "gocb_ref").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ev).alias("changes"),
        F.count_if(ev & (F.col("attack") == 1)).alias("attacks_during_changes"))


def top_device_events(df: DataFrame) -> DataFrame:
    """The busiest device of each attack type and its change/attack counts."""
    d = device_events(df)
    best = F.min_by(F.struct("gocb_ref", "n", "changes", "attacks_during_changes"),
                    F.struct((-F.col("n")).alias("k"), F.col("gocb_ref")))
    t = d.groupBy("attack_type").agg(best.alias("b")).select("attack_type", "b.*")
    return t.withColumn("attack_rate", F.when(F.col("changes") > 0,
                                              F.col("attacks_during_changes") / F.col("changes")))


def rule_violations(df: DataFrame) -> DataFrame:
    """Per device (>= 2 rows): messages, changes, changes without sqNum reset, of those attacks, rate."""
    s = stream.segmented(df, ["gocb_ref"], "time_s")
    order = [F.col("time_s").asc_nulls_last(), F.col("packet_id")]
    s = stream.windowed(s, ["gocb_ref"], order, _stream_build_lag("st_num", "_prev_st"), 1)
    ev = F.coalesce(F.col("st_num") != F.col("_prev_st"), F.lit(True))
    viol = ev & ~F.coalesce(F.col("sq_num") == 0, F.lit(False))
    g = s.groupBy("gocb_ref").agg(
        F.count(F.lit(1)).alias("total_messages"), F.count_if(ev).alias("st_changes"),
        F.count_if(viol).alias("rule1_violations"),
        F.count_if(viol & (F.col("attack") == 1)).alias("violations_attacks"))
    return g.filter(F.col("total_messages") >= 2).withColumn(
        "rule1_violation_rate",
        F.when(F.col("st_changes") > 0, F.col("rule1_violations") / F.col("st_changes")).otherwise(0.0))


def class_distribution(labelled: DataFrame) -> DataFrame:
    """Count and % per class per split."""
    g = labelled.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("split")))
