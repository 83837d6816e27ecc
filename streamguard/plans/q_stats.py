"""Registered queries: preparation, statistics, EDA profiles, joins, windows, sampling
(M*, A*, J*, W*, T*, P*, U*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schema
from ..operators import gram
from ..operators import sampling as SA
from ..operators import stats as ST
from ..operators import stream
from ..sources import ingest
from . import context as ctx
from . import oracles as O
from .registry import query

CORE = list(schema.CORE_NUMERIC)
FULL = schema.mode_features("full")
DESCRIBE_COLS = CORE + ["time_s", "value"]


def _q(name: str) -> str:
    return f'"{name}"'


def unpivot(src: str, cols, ids, where: str = "", nulls: bool = True) -> str:
    casts = ", ".join(f"CAST({_q(c)} AS DOUBLE) AS {_q(c)}" for c in cols)
    inner = f"(SELECT {', '.join(ids)}, {casts} FROM {src} {where})"
    inc = "INCLUDE NULLS " if nulls else ""
    return f"(SELECT * FROM {inner} UNPIVOT {inc}(value FOR feature IN ({', '.join(_q(c) for c in cols)})))"


def eda(spark, sf):
    """EDA reads the training files only."""
    return ctx.typed(spark, sf).filter(F.col("split") == "train")


def train_full(spark, sf):
    return ctx.full(spark, sf).filter(F.col("split") == "train")


TRAIN = "WHERE split = 'train'"

# ------------------------------------------------------------------ M: preparation


def _prep_sql(src: str, cols, ids=("packet_id", "attack_type", "attack"), strict: bool = False,
              keep_always=()) -> str:
    """CTEs long -> prof -> keep1 -> filled -> keep2 -> z (M2-M5 in SQL)."""
    cmp = ">" if strict else ">="
    always = (" OR feature IN (" + ", ".join(f"'{c}'" for c in keep_always) + ")") if keep_always else ""
    return f"""
long AS (SELECT * FROM {unpivot(src, cols, ids, TRAIN)}),
prof AS (SELECT feature, COUNT(*) AS n, COUNT(value) AS nn, median(value) AS med FROM long GROUP BY feature),
keep1 AS (SELECT feature, coalesce(med, 0.0) AS fill FROM prof WHERE nn {cmp} 0.5 * n{always}),
filled AS (SELECT l.*, coalesce(l.value, k.fill) AS v FROM long l JOIN keep1 k USING (feature)),
keep2 AS (SELECT feature, avg(v) AS m, stddev_pop(v) AS s, var_samp(v) AS var FROM filled GROUP BY feature
          HAVING max(v) > min(v)),
z AS (SELECT f.*, coalesce(CASE WHEN k.s > 0 THEN (f.v - k.m) / k.s END, 0.0) AS z
      FROM filled f JOIN keep2 k USING (feature))"""


@query("drop_sparse", "M2", O.sql(
    "SELECT feature, " + O.r("nn / n", "share") + ", CAST(nn >= 0.5 * n AS BIGINT) AS keep_characterize, "
    "CAST(nn > 0.5 * n OR feature = 'boolean_1' AS BIGINT) AS keep_detect FROM prof", _prep_sql("features", FULL),
    full=True))
def drop_sparse(spark, sf):
    """Non-null share per feature and both keep rules (>= 0.5; > 0.5 with boolean_1 kept)."""
    prof = ST.nonnull_shares(train_full(spark, sf), FULL)
    return prof.select("feature", "share",
                       (F.col("share") >= ST.MIN_NONNULL_SHARE).cast("bigint").alias("keep_characterize"),
                       ((F.col("share") > ST.MIN_NONNULL_SHARE) | (F.col("feature") == "boolean_1"))
                       .cast("bigint").alias("keep_detect"))


@query("impute_median", "M3", O.sql(
    "SELECT feature, " + O.r("med", "median") + ", " + O.r("fill", "fill") + " FROM prof JOIN keep1 USING (feature)",
    _prep_sql("features", FULL), full=True))
def impute_median(spark, sf):
    """Train median per kept feature and the fill value used (0 when no median)."""
    prof = ST.feature_profile(train_full(spark, sf), FULL)
    kept = prof.filter(F.col("share") >= ST.MIN_NONNULL_SHARE)
    return kept.select("feature", "median", F.coalesce("median", F.lit(0.0)).alias("fill"))


@query("drop_constant", "M4", O.sql(
    "SELECT feature, " + O.r("var", "variance") + " FROM keep2", _prep_sql("features", FULL), full=True))
def drop_constant(spark, sf):
    """Features left after the variance filter, with their sample variance."""
    df = train_full(spark, sf)
    kept, med, _ = ST.prepare(df, FULL, scale=False)
    filled = ST.impute(df, med, kept)
    return ST.variance_rank(filled, kept).select("feature", "variance")


@query("standardize", "M5", O.sql(
    "SELECT packet_id, feature, " + O.r("z", "z") + " FROM z", _prep_sql("typed", CORE), full=False))
def standardize(spark, sf):
    """Core features: prune, median fill, z-score (population std), long output per packet."""
    df = eda(spark, sf)
    kept, med, mom = ST.prepare(df, CORE)
    z = ST.clean_matrix(df, kept, med, mom)
    return ST.long_values(z, kept, ["packet_id"]).withColumnRenamed("value", "z")


@query("minmax", "M6", O.sql(
    "SELECT packet_id, " + O.r("(inter_arrival - min(inter_arrival) OVER ()) / "
                               "(max(inter_arrival) OVER () - min(inter_arrival) OVER ())", "scaled")
    + " FROM features WHERE split = 'train' AND attack = 0 AND inter_arrival IS NOT NULL", full=True))
def minmax(spark, sf):
    """Normal train gaps scaled to [0, 1]."""
    d = train_full(spark, sf).filter((F.col("attack") == 0) & F.col("inter_arrival").isNotNull())
    r = d.agg(F.min("inter_arrival").alias("lo"), F.max("inter_arrival").alias("hi")).collect()[0]
    return d.select("packet_id", ((F.col("inter_arrival") - r["lo"]) / (r["hi"] - r["lo"])).alias("scaled"))


_UCAD = [c for c in schema.UCAD_FEATURES]


@query("zero_fill", "M7", O.sql(
    "SELECT packet_id, feature, " + O.r("coalesce(CASE WHEN s > 0 THEN (v - m) / s END, 0.0)", "z")
    + " FROM (SELECT *, avg(v) OVER (PARTITION BY feature) AS m, stddev_pop(v) OVER (PARTITION BY feature) AS s "
    "FROM (SELECT packet_id, feature, coalesce(value, 0.0) AS v FROM "
    + unpivot("features", _UCAD, ["packet_id"], TRAIN) + "))", full=True))
def zero_fill(spark, sf):
    """UCAD inputs: null / inf -> 0, then z-score (population std)."""
    df = train_full(spark, sf)
    filled = df.select("packet_id", *[F.coalesce(ST.dbl(c), F.lit(0.0)).alias(c) for c in _UCAD])
    mom = ST.moments(filled, _UCAD)
    z = ST.standardize(filled, mom, _UCAD)
    return ST.long_values(z, _UCAD, ["packet_id"]).withColumnRenamed("value", "z")


_CLASS_IDX = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(schema.CLASSES))


@query("label_index", "M10", O.sql(
    "SELECT packet_id, CASE WHEN attack = 0 THEN 'normal' ELSE lower(attack_type) END AS label, "
    f"CAST(CASE (CASE WHEN attack = 0 THEN 'normal' ELSE lower(attack_type) END) {_CLASS_IDX} END AS BIGINT) "
    "AS label_idx FROM typed"))
def label_index(spark, sf):
    """Five-class label to its index (normal, injection, masquerade, poisoning, replay)."""
    lab = ingest.tag_multiclass(ctx.typed(spark, sf))
    m = F.create_map(*[x for i, c in enumerate(schema.CLASSES) for x in (F.lit(c), F.lit(i))])
    return lab.select("packet_id", "label", m[F.col("label")].alias("label_idx"))


# ------------------------------------------------------------------ A: statistics

@query("overall_counts", "A1", O.sql(
    "SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE attack = 0) AS normal, "
    "COUNT(*) FILTER (WHERE attack = 1) AS attacks, " + O.r("avg(attack)", "attack_ratio")
    + " FROM typed WHERE split = 'train'"))
def overall_counts(spark, sf):
    return ST.overall_counts(eda(spark, sf))


@query("attack_dist", "A2", O.sql(
    "SELECT attack_type, COUNT(*) FILTER (WHERE attack = 0) AS n_normal, COUNT(*) FILTER (WHERE attack = 1) "
    "AS n_attack FROM typed WHERE split = 'train' GROUP BY attack_type"))
def attack_dist(spark, sf):
    return ST.attack_dist(eda(spark, sf))


@query("device_counts", "A3", O.sql(
    "SELECT (SELECT COUNT(DISTINCT gocb_ref) FROM typed WHERE split = 'train') AS n_devices, gocb_ref AS top_device, "
    "n AS top_count FROM (SELECT gocb_ref, COUNT(*) AS n FROM typed WHERE split = 'train' GROUP BY gocb_ref "
    "ORDER BY n DESC, gocb_ref LIMIT 1)"))
def device_counts(spark, sf):
    return ST.device_counts(eda(spark, sf))


@query("describe_all", "A4", O.sql(
    "SELECT feature, COUNT(value) AS count, " + O.r("avg(value)", "mean") + ", " + O.r("stddev_samp(value)", "std")
    + ", " + O.r("min(value)", "min") + ", " + O.r("quantile_cont(value, 0.25)", "p25") + ", "
    + O.r("quantile_cont(value, 0.5)", "p50") + ", " + O.r("quantile_cont(value, 0.75)", "p75") + ", "
    + O.r("max(value)", "max") + " FROM " + unpivot("typed", DESCRIBE_COLS, ["packet_id"], TRAIN)
    + " GROUP BY feature"))
def describe_all(spark, sf):
    """count, mean, std, min, quartiles, max of every numeric column (train)."""
    return ST.describe(eda(spark, sf), DESCRIBE_COLS)


# every other column of the typed packets; source and destination too, numbers are in DESCRIBE_COLS
DESCRIBE_TEXT = ["attack_type", "gocb_ref", "t", "boolean_raw", "bit_string", "source", "destination", "go_id",
                 "dat_set"]


def _describe_columns_sql() -> str:
    nums = ("NULL AS \"unique\", CAST(NULL AS VARCHAR) AS top, NULL AS freq")
    text = ", ".join(f"CAST({_q(c)} AS VARCHAR) AS {_q(c)}" for c in DESCRIBE_TEXT)
    return O.sql(
        "SELECT feature, COUNT(value) AS count, " + nums + ", " + O.r("avg(value)", "mean") + ", "
        + O.r("stddev_samp(value)", "std") + ", " + O.r("min(value)", "min") + ", "
        + ", ".join(O.r(f"quantile_cont(value, {p})", n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
        + ", " + O.r("max(value)", "max") + " FROM " + unpivot("typed", DESCRIBE_COLS, ["packet_id"], TRAIN)
        + " GROUP BY feature UNION ALL SELECT feature, CAST(SUM(c) AS BIGINT), COUNT(value), "
        "arg_min(value, (-c, value)), max(c) FILTER (WHERE value IS NOT NULL), "
        "NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM counts GROUP BY feature",
        f"counts AS (SELECT feature, value, COUNT(value) AS c FROM (SELECT {text} FROM typed {TRAIN}) "
        f"UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(_q(c) for c in DESCRIBE_TEXT)})) "
        "GROUP BY feature, value)")


@query("describe_columns", "A4", _describe_columns_sql())
def describe_columns(spark, sf):
    """Every column (train): count, moments and quartiles of numbers; unique, top and its count of the others."""
    return ST.describe_columns(eda(spark, sf), DESCRIBE_COLS, DESCRIBE_TEXT)


def _mw_sql(src: str, cols) -> str:
    return f"""
lv AS (SELECT * FROM {unpivot(src, cols, ['attack_type', 'attack'], TRAIN, nulls=False)} WHERE NOT isnan(value)),
pv AS (SELECT attack_type, feature, value, COUNT(*) AS c, COUNT(*) FILTER (WHERE attack = 0) AS c0
       FROM lv GROUP BY attack_type, feature, value),
rk AS (SELECT *, coalesce(SUM(c) OVER (PARTITION BY attack_type, feature ORDER BY value
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb FROM pv),
g AS (SELECT attack_type, feature, CAST(SUM(c0) AS DOUBLE) AS n0, CAST(SUM(c) - SUM(c0) AS DOUBLE) AS n1,
             SUM(c0 * (cb + (c + 1) / 2.0)) AS r0, SUM(CAST(c AS DOUBLE) ^ 3 - c) AS ties
      FROM rk GROUP BY attack_type, feature),
mw AS (SELECT attack_type, feature, n0, n1, r0 - n0 * (n0 + 1) / 2.0 AS u,
              (greatest(r0 - n0 * (n0 + 1) / 2.0, n0 * n1 - (r0 - n0 * (n0 + 1) / 2.0)) - n0 * n1 / 2.0 - 0.5)
              / nullif(sqrt(n0 * n1 / 12.0 * ((n0 + n1 + 1) - ties / nullif((n0 + n1) * (n0 + n1 - 1), 0))), 0) AS z
       FROM g WHERE n0 > 0 AND n1 > 0),
mwp AS (SELECT *, least(1.0, 2.0 * {_sf_sql('z')}) AS p_value FROM mw)"""


def _erfc_sql(x: str) -> str:
    t = f"(1.0 / (1.0 + 0.5 * {x}))"
    poly = f"{ST._ERFC_COEF[-1]!r}"
    for c in reversed(ST._ERFC_COEF[:-1]):
        poly = f"({poly} * {t} + {c!r})"
    return f"({t} * exp(-{x} * {x} + {poly}))"


def _sf_sql(z: str) -> str:
    x = f"(abs({z}) / sqrt(2.0))"
    return f"(CASE WHEN {z} >= 0 THEN 0.5 * {_erfc_sql(x)} ELSE 1.0 - 0.5 * {_erfc_sql(x)} END)"


@query("mann_whitney", "A6", O.sql(
    "SELECT attack_type, feature, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1, " + O.r("u", "u") + ", "
    + O.r("z", "z") + ", " + O.r("p_value", "p_value") + " FROM mwp", _mw_sql("typed", CORE)))
def mann_whitney(spark, sf):
    """Two-sided Mann-Whitney U per (attack type, core feature): normal vs attack rows (train)."""
    return ST.mann_whitney(eda(spark, sf), CORE)


@query("feature_stats", "A5", O.sql(
    "SELECT s.attack_type, s.feature, " + O.r("normal_mean", "normal_mean") + ", " + O.r("normal_std", "normal_std")
    + ", " + O.r("attack_mean", "attack_mean") + ", " + O.r("attack_std", "attack_std") + ", "
    + O.r("abs(attack_mean - normal_mean)", "mean_difference") + ", " + O.r("p_value", "p_value")
    + ", CAST(p_value < 0.01 AS BIGINT) AS significant FROM (SELECT attack_type, feature, "
    "avg(value) FILTER (WHERE attack = 0) AS normal_mean, stddev_samp(value) FILTER (WHERE attack = 0) AS normal_std, "
    "avg(value) FILTER (WHERE attack = 1) AS attack_mean, stddev_samp(value) FILTER (WHERE attack = 1) AS attack_std "
    "FROM lv GROUP BY attack_type, feature) s JOIN mwp USING (attack_type, feature)",
    _mw_sql("features", FULL), full=True))
def feature_stats(spark, sf):
    """Per (attack type, full-mode feature): means/stds by label, |diff|, Mann-Whitney p, p < 0.01."""
    return ST.feature_stats(train_full(spark, sf), FULL)


_SIG = ["st_num", "sq_num", "ttl_ms", "length"] + ST.SIGNATURE_FEATURES


@query("attack_signatures", "A7", O.sql(
    "SELECT attack_type, COUNT(*) AS num_samples, COUNT(*) FILTER (WHERE attack = 1) AS num_attack, "
    + O.r("COUNT(*) FILTER (WHERE attack = 1) / greatest(COUNT(*), 1)", "attack_ratio") + ", "
    + ", ".join(O.r(f"avg(CAST({c} AS DOUBLE)) FILTER (WHERE attack = {k})", f"{c}_mean_{n}")
                for c in _SIG for k, n in ((0, "normal"), (1, "attack")))
    + " FROM features WHERE split = 'train' GROUP BY attack_type", full=True))
def attack_signatures(spark, sf):
    """Per attack type: sizes, attack ratio and per-label means of the signature features."""
    return ST.attack_signatures(train_full(spark, sf), _SIG)


def _sep_sql(src: str, cols) -> str:
    return _prep_sql(src, cols) + """,
per AS (SELECT attack_type, feature, avg(z) FILTER (WHERE attack = 1) AS ma, avg(z) FILTER (WHERE attack = 0) AS mn,
               var_pop(z) FILTER (WHERE attack = 1) AS va, var_pop(z) FILTER (WHERE attack = 0) AS vn,
               COUNT(*) FILTER (WHERE attack = 1) AS na, COUNT(*) FILTER (WHERE attack = 0) AS nn
        FROM z GROUP BY attack_type, feature),
sep AS (SELECT upper(substr(attack_type, 1, 1)) || lower(substr(attack_type, 2)) AS attack_type,
               sqrt(SUM((ma - mn) * (ma - mn))) AS inter, (avg(va) + avg(vn)) / 2 AS intra
        FROM per GROUP BY attack_type HAVING min(na) > 0 AND min(nn) > 0),
sep2 AS (SELECT *, inter / (sqrt(intra) + 1e-6) AS score FROM sep)"""


_SEP_SELECT = ("SELECT attack_type, " + O.r("inter", "inter_class_distance") + ", "
               + O.r("intra", "intra_class_variance") + ", " + O.r("score", "separability_score")
               + ", CASE WHEN score > 5 THEN 'Easy' WHEN score > 2 THEN 'Medium' ELSE 'Hard' END "
               "AS detection_difficulty FROM sep2")


def separability_frame(spark, sf, mode: str):
    df = train_full(spark, sf)
    cols = FULL if mode == "full" else CORE
    kept, med, mom = ST.prepare(df, cols)
    return ST.separability(ST.clean_matrix(df, kept, med, mom), kept)


@query("attack_difficulty", "A8", O.sql(_SEP_SELECT, _sep_sql("features", FULL), full=True))
def attack_difficulty(spark, sf):
    """Separability of attack vs normal rows per attack type (full mode, standardized)."""
    return separability_frame(spark, sf, "full")


@query("variance_rank", "A9", O.sql(
    "SELECT feature, " + O.r("var", "variance") + ", CAST(dense_rank() OVER (ORDER BY " + O.rx("var") + " DESC) AS BIGINT) "
    "AS variance_rank FROM keep2", _prep_sql("features", FULL), full=True))
def variance_rank(spark, sf):
    """Sample variance of each usable full-mode feature with its dense rank."""
    df = train_full(spark, sf)
    kept, med, _ = ST.prepare(df, FULL, scale=False)
    return ST.variance_rank(ST.impute(df, med, kept), kept)


def corr_sql(a: str, b: str) -> str:
    """Pearson over complete pairs; null when either side is constant (as the Spark side)."""
    f = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return (f"(covar_pop({a}, {b}) {f} / nullif(stddev_pop({a}) {f} * stddev_pop({b}) {f}, 0))")


def _numbers_sql(name: str, src: str, cols, where: str) -> str:
    casts = ", ".join(f"CAST({_q(c)} AS DOUBLE) AS {_q(c)}" for c in cols)
    return f"{name} AS MATERIALIZED (SELECT row_number() OVER () AS _row, {casts}, attack FROM {src} {where})"


def _pairs_sql(name: str, src: str, cols) -> str:
    """CTEs: ``name`` (fa, fb, c) for every column pair of ``src``, from its values joined with themselves by row."""
    order = ", ".join(f"({k}, '{c}')" for k, c in enumerate(cols))
    corr = "covar_pop(a.value, b.value) / nullif(stddev_pop(a.value) * stddev_pop(b.value), 0)"
    return (f"{name}_o AS (SELECT * FROM (VALUES {order}) v(k, feature)), {name}_v AS MATERIALIZED "
            f"(SELECT u._row, o.k, u.value FROM (SELECT _row, {', '.join(_q(c) for c in cols)} FROM {src}) "
            f"UNPIVOT (value FOR feature IN ({', '.join(_q(c) for c in cols)})) u JOIN {name}_o o USING (feature)), "
            f"{name}_c AS (SELECT a.k AS ka, b.k AS kb, {corr} AS c FROM {name}_v a JOIN {name}_v b "
            f"ON a._row = b._row AND a.k < b.k GROUP BY a.k, b.k), "
            f"{name} AS (SELECT x.feature AS fa, y.feature AS fb, c FROM {name}_o x JOIN {name}_o y ON x.k < y.k "
            f"LEFT JOIN {name}_c ON ka = x.k AND kb = y.k)")


def _corr_matrix_sql(src: str, cols) -> str:
    return O.sql("SELECT fa AS feature_a, fb AS feature_b, " + O.r("c", "corr") + " FROM pairs",
                 _numbers_sql("numbers", src, cols, TRAIN), _pairs_sql("pairs", "numbers", cols),
                 full=src == "features")


def _corr_matrix(df, cols):
    return gram.correlations(df, cols).select(
        F.col("fa").alias("feature_a"), F.col("fb").alias("feature_b"), "corr")


@query("corr_matrix", "A10", _corr_matrix_sql("typed", CORE))
def corr_matrix(spark, sf):
    """Pearson correlation of every pair of core features (pairwise complete, train)."""
    return _corr_matrix(eda(spark, sf), CORE)


@query("corr_matrix_full", "A10", _corr_matrix_sql("features", FULL))
def corr_matrix_full(spark, sf):
    """Pearson correlation of every pair of full-mode features (pairwise complete, train)."""
    return _corr_matrix(train_full(spark, sf), FULL)


@query("corr_with_label", "A11", O.sql(
    "SELECT feature, " + O.r(corr_sql("value", "CAST(attack AS DOUBLE)"), "corr") + " FROM "
    + unpivot("features", FULL, ["attack"], TRAIN) + " GROUP BY feature", full=True))
def corr_with_label(spark, sf):
    """Correlation of each full-mode feature with the attack label (train)."""
    return ST.corr_with_label(train_full(spark, sf), FULL)


def _corr_delta_sql(src: str, cols) -> str:
    ctes = [_numbers_sql("numbers", src, cols, TRAIN)]
    for lab in (0, 1):
        ctes.append(f"med{lab} AS (SELECT " + ", ".join(
            f"median({_q(c)}) AS {_q(c)}, COUNT({_q(c)}) >= floor(0.5 * COUNT(*)) AS \"ok_{c}\"" for c in cols)
            + f" FROM numbers WHERE attack = {lab})")
        ctes.append(f"fill{lab} AS MATERIALIZED (SELECT " + ", ".join(
            f"CASE WHEN m.\"ok_{c}\" THEN coalesce(n.{_q(c)}, m.{_q(c)}) END AS {_q(c)}" for c in cols)
            + f", n._row FROM numbers n, med{lab} m WHERE attack = {lab})")
        ctes.append(_pairs_sql(f"c{lab}", f"fill{lab}", cols))
    return O.sql(
        "SELECT c1.fa AS feature_a, c1.fb AS feature_b, "
        + O.r("least(greatest(c1.c, -1), 1) - least(greatest(c0.c, -1), 1)", "corr_delta")
        + " FROM c0 JOIN c1 USING (fa, fb) WHERE c0.c IS NOT NULL AND c1.c IS NOT NULL",
        *ctes, full=src == "features")


@query("corr_delta", "A12", _corr_delta_sql("typed", CORE))
def corr_delta(spark, sf):
    """Correlation change (attack minus normal) of core feature pairs after per-label median fill."""
    return ST.corr_delta(eda(spark, sf), CORE)


@query("corr_delta_full", "A12", _corr_delta_sql("features", FULL))
def corr_delta_full(spark, sf):
    """Correlation change (attack minus normal) of full-mode feature pairs after per-label median fill."""
    return ST.corr_delta(train_full(spark, sf), FULL)


@query("hour_profile", "A13", O.sql(
    "SELECT CAST(hour(TRY_CAST(t AS TIMESTAMP)) AS BIGINT) AS hour, "
    "CAST(isodow(TRY_CAST(t AS TIMESTAMP)) - 1 AS BIGINT) AS dayofweek, CAST(attack AS BIGINT) AS attack, "
    "COUNT(*) AS n FROM typed WHERE split = 'train' GROUP BY ALL"))
def hour_profile(spark, sf):
    """Messages per hour of day x weekday x label (train)."""
    return ST.hour_profile(eda(spark, sf))


@query("attack_by_hour", "A14", O.sql(
    "SELECT attack_type, " + ", ".join(
        f"COUNT(*) FILTER (WHERE hour(TRY_CAST(t AS TIMESTAMP)) = {h}) AS h{h:02d}" for h in range(24))
    + " FROM typed WHERE split = 'train' AND attack = 1 GROUP BY attack_type"))
def attack_by_hour(spark, sf):
    """Attack rows per attack type x hour, zero filled."""
    return ST.attack_by_hour(eda(spark, sf))


_TOP10 = ("(SELECT gocb_ref FROM (SELECT gocb_ref, COUNT(*) AS n FROM typed WHERE split = 'train' "
          "GROUP BY gocb_ref ORDER BY n DESC, gocb_ref LIMIT 10))")


@query("device_attack_pct", "A15", O.sql(
    "SELECT gocb_ref, " + O.r("100.0 * COUNT(*) FILTER (WHERE attack = 0) / COUNT(*)", "pct_normal") + ", "
    + O.r("100.0 * COUNT(*) FILTER (WHERE attack = 1) / COUNT(*)", "pct_attack")
    + f" FROM typed WHERE split = 'train' AND gocb_ref IN {_TOP10} GROUP BY gocb_ref"))
def device_attack_pct(spark, sf):
    """Share of normal / attack rows for the 10 busiest devices."""
    return ST.device_attack_pct(eda(spark, sf))


@query("attack_by_device", "A16", O.sql(
    "SELECT gocb_ref, " + ", ".join(f"COUNT(*) FILTER (WHERE attack_type = '{t}') AS {t}" for t in schema.ATTACK_TYPES)
    + ", COUNT(*) AS total FROM typed WHERE split = 'train' AND attack = 1 GROUP BY gocb_ref "
    "ORDER BY total DESC, gocb_ref LIMIT 10"))
def attack_by_device(spark, sf):
    """Attack rows per device x attack type, top 10 devices by attacks."""
    return ST.attack_by_device(eda(spark, sf))


_WDEV = "(PARTITION BY gocb_ref ORDER BY time_s NULLS LAST, packet_id)"


@query("bool_change_rate", "A17", O.sql(
    "SELECT attack_type, CAST(attack AS BIGINT) AS attack, "
    + O.r("100.0 * avg(CAST(coalesce(boolean_raw <> prev, true) AS DOUBLE))", "change_pct")
    + f" FROM (SELECT *, lag(boolean_raw) OVER {_WDEV} AS prev FROM typed WHERE split = 'train') "
    "GROUP BY attack_type, attack"))
def bool_change_rate(spark, sf):
    """% of rows whose flag text differs from the device's previous row (first row counts)."""
    return ST.bool_change_rate(eda(spark, sf))


@query("bool_true_hist", "A18", O.sql(
    "SELECT CAST(length(coalesce(boolean_raw, 'nan')) - length(replace(coalesce(boolean_raw, 'nan'), 'True', '')) "
    "AS BIGINT) // 4 AS true_count, CAST(attack AS BIGINT) AS attack, COUNT(*) AS n FROM typed "
    "WHERE split = 'train' GROUP BY ALL"))
def bool_true_hist(spark, sf):
    """Rows by number of 'True' tokens in the flag text and label."""
    return ST.bool_true_hist(eda(spark, sf))


def _hist_sql(src: str, keys: str, value: str = "gap") -> str:
    return (f"SELECT {keys}, CAST(least(floor(({value} - lo) / (hi - lo) * 50), 49) AS BIGINT) AS bin, "
            f"COUNT(*) AS n, {O.rx('min(lo)')} AS lo, {O.rx('min(hi)')} AS hi FROM "
            f"(SELECT *, min({value}) OVER (PARTITION BY {keys}) AS lo, max({value}) OVER (PARTITION BY {keys}) AS hi "
            f"FROM {src}) GROUP BY ALL")


@query("gap_hist", "A19", O.sql(
    _hist_sql("(SELECT * FROM gq WHERE gap < q)", "attack_type"),
    "gp AS (SELECT attack_type, time_s - lag(time_s) OVER (PARTITION BY attack_type ORDER BY time_s NULLS LAST, "
    "packet_id) AS gap FROM typed WHERE split = 'train'), gq AS (SELECT *, quantile_cont(gap, 0.99) OVER "
    "(PARTITION BY attack_type) AS q FROM gp WHERE gap IS NOT NULL)"))
def gap_hist(spark, sf):
    """Inter-message gaps in each attack type's time order, below their 99 % quantile, 50 bins."""
    return ST.gap_hist(eda(spark, sf))


@query("feature_hist", "A20", O.sql(
    "SELECT CAST(attack AS BIGINT) AS attack, CAST(least(floor((x - lo) / (hi - lo) * 50), 49) AS BIGINT) AS bin, "
    "COUNT(*) AS n, " + O.rx("min(lo)") + " AS lo, " + O.rx("min(hi)") + " AS hi FROM (SELECT *, "
    "min(x) OVER (PARTITION BY attack) AS lo, max(x) OVER (PARTITION BY attack) AS hi FROM "
    "(SELECT attack, CASE WHEN max(byte_rate) OVER (PARTITION BY attack) > 1000 THEN "
    "(CASE WHEN byte_rate > 0 THEN log10(byte_rate) END) ELSE byte_rate END AS x FROM features "
    "WHERE split = 'train') WHERE x IS NOT NULL) GROUP BY ALL", full=True))
def feature_hist(spark, sf):
    """50-bin histogram of byte_rate by label, log10 bins when the maximum exceeds 1000."""
    d = train_full(spark, sf)
    return ST.histogram(d, "byte_rate", ["attack"], log_above=ST.LOG_BINS_ABOVE)


@query("gap_hist_by_label", "A19", O.sql(
    "SELECT attack_type, CAST(attack AS BIGINT) AS attack, CASE WHEN hi > lo THEN CAST(least(floor((gap - lo) / "
    "(hi - lo) * 50), 49) AS BIGINT) ELSE 0 END AS bin, COUNT(*) AS n, " + O.rx("min(lo)") + " AS lo, " + O.rx("min(hi)")
    + " AS hi FROM (SELECT *, min(gap) OVER k AS lo, max(gap) OVER k AS hi FROM gq WHERE gap < q "
    "WINDOW k AS (PARTITION BY attack_type, attack)) GROUP BY ALL",
    "gp AS (SELECT attack_type, attack, time_s - lag(time_s) OVER (PARTITION BY attack_type, attack ORDER BY time_s "
    "NULLS LAST, packet_id) AS gap FROM typed WHERE split = 'train'), gq AS (SELECT *, quantile_cont(gap, 0.99) OVER "
    "(PARTITION BY attack_type, attack) AS q FROM gp WHERE gap IS NOT NULL)"))
def gap_hist_by_label(spark, sf):
    """As gap_hist, for the messages of each label apart."""
    return ST.gap_hist(eda(spark, sf), by_label=True)


@query("feature_hists", "A20", O.sql(
    "SELECT feature, CAST(attack AS BIGINT) AS attack, CASE WHEN hi > lo THEN CAST(least(floor((x - lo) / (hi - lo) * 50), "
    "49) AS BIGINT) ELSE 0 END AS bin, COUNT(*) AS n, " + O.rx("min(lo)") + " AS lo, " + O.rx("min(hi)")
    + " AS hi FROM (SELECT *, min(x) OVER k AS lo, max(x) OVER k AS hi FROM (SELECT feature, attack, CASE WHEN "
    "max(v) OVER (PARTITION BY feature, attack) > 1000 THEN (CASE WHEN v > 0 THEN log10(v) END) ELSE v END AS x FROM lv) "
    "WHERE x IS NOT NULL WINDOW k AS (PARTITION BY feature, attack)) GROUP BY ALL",
    "lv AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, attack, CAST({c} AS DOUBLE) AS v FROM features "
                                   f"WHERE split = 'train' AND {c} IS NOT NULL" for c in schema.CORE_NUMERIC) + ")",
    full=True))
def feature_hists(spark, sf):
    """50-bin histogram of every core feature by label, log10 bins when the maximum exceeds 1000."""
    return ST.histograms(train_full(spark, sf), list(schema.CORE_NUMERIC), ["attack"], log_above=ST.LOG_BINS_ABOVE)


@query("interval_vs_ttl", "A21", O.sql(
    "SELECT packet_id, CAST(attack AS BIGINT) AS attack, " + O.r("actual", "actual_interval") + ", "
    + O.r("ttl_ms / 2000.0", "expected_interval")
    + f" FROM (SELECT *, time_s - lag(time_s) OVER {_WDEV} AS actual FROM typed WHERE split = 'train') "
    "WHERE actual IS NOT NULL AND ttl_ms IS NOT NULL"))
def interval_vs_ttl(spark, sf):
    """Expected (TTL / 2) vs actual device gap for every complete row (train)."""
    return ST.interval_vs_ttl(eda(spark, sf))


@query("event_timeline", "A22", O.sql(
    "SELECT attack_type, COUNT(*) AS total_msgs, COUNT(*) FILTER (WHERE ev) AS total_events, "
    "COUNT(*) FILTER (WHERE attack = 1) AS total_attacks, COUNT(*) FILTER (WHERE ev AND attack = 1) "
    "AS events_with_attacks FROM (SELECT *, coalesce(st_num <> lag(st_num) OVER (PARTITION BY attack_type "
    "ORDER BY time_s NULLS LAST, packet_id), true) AS ev FROM typed WHERE split = 'train') GROUP BY attack_type"))
def event_timeline(spark, sf):
    """Per attack type in time order: messages, state changes, attacks, attacks at changes."""
    return ST.event_timeline(eda(spark, sf))


@query("event_messages", "A22", O.sql(
    "SELECT packet_id, attack_type, CASE WHEN ev AND attack = 1 THEN 'event_attack' WHEN attack = 1 THEN 'attack' "
    "WHEN ev THEN 'event' ELSE 'heartbeat' END AS kind FROM (SELECT *, coalesce(st_num <> lag(st_num) OVER "
    "(PARTITION BY attack_type ORDER BY time_s NULLS LAST, packet_id), true) AS ev FROM typed WHERE split = 'train')"))
def event_messages(spark, sf):
    """Class of every message on its attack type's timeline."""
    return ST.event_messages(eda(spark, sf))


@query("state_evolution", "A23", O.sql(
    "SELECT attack_type, msg_index, st_num FROM (SELECT attack_type, st_num, ROW_NUMBER() OVER "
    "(PARTITION BY attack_type ORDER BY packet_id) - 1 AS msg_index FROM typed WHERE split = 'train') "
    "WHERE msg_index < 1000"))
def state_evolution(spark, sf):
    """stNum by message index, first 1000 messages of each attack type."""
    return ST.state_evolution(eda(spark, sf))


_DEV_EVENTS = ("(SELECT attack_type, gocb_ref, COUNT(*) AS n, COUNT(*) FILTER (WHERE ev) AS changes, "
               "COUNT(*) FILTER (WHERE ev AND attack = 1) AS attacks_during_changes FROM (SELECT *, "
               "coalesce(st_num <> lag(st_num) OVER (PARTITION BY attack_type, gocb_ref ORDER BY time_s NULLS LAST, "
               "packet_id), true) AS ev FROM typed WHERE split = 'train') GROUP BY attack_type, gocb_ref)")


@query("top_device_events", "A24", O.sql(
    "SELECT attack_type, gocb_ref, n, changes, attacks_during_changes, "
    + O.r("CASE WHEN changes > 0 THEN attacks_during_changes / changes END", "attack_rate")
    + f" FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY attack_type ORDER BY n DESC, gocb_ref) AS rk FROM {_DEV_EVENTS}) "
    "WHERE rk = 1"))
def top_device_events(spark, sf):
    """Busiest device of each attack type: state changes and attacks during them."""
    return ST.top_device_events(eda(spark, sf))


@query("rule_violations", "A25", O.sql(
    "SELECT gocb_ref, COUNT(*) AS total_messages, COUNT(*) FILTER (WHERE ev) AS st_changes, "
    "COUNT(*) FILTER (WHERE ev AND NOT coalesce(sq_num = 0, false)) AS rule1_violations, "
    "COUNT(*) FILTER (WHERE ev AND NOT coalesce(sq_num = 0, false) AND attack = 1) AS violations_attacks, "
    + O.r("CASE WHEN COUNT(*) FILTER (WHERE ev) > 0 THEN COUNT(*) FILTER (WHERE ev AND NOT coalesce(sq_num = 0, false))"
          " / COUNT(*) FILTER (WHERE ev) ELSE 0.0 END", "rule1_violation_rate")
    + f" FROM (SELECT *, coalesce(st_num <> lag(st_num) OVER {_WDEV}, true) AS ev FROM typed "
    "WHERE split = 'train') GROUP BY gocb_ref HAVING COUNT(*) >= 2"))
def rule_violations(spark, sf):
    """Per device: state changes, changes without a sqNum reset (rule 1), of those during attacks, rate."""
    return ST.rule_violations(eda(spark, sf))


@query("class_distribution", "A26", O.sql(
    "SELECT split, label, n, " + O.r("100.0 * n / SUM(n) OVER (PARTITION BY split)", "pct")
    + " FROM (SELECT split, CASE WHEN attack = 0 THEN 'normal' ELSE lower(attack_type) END AS label, "
    "COUNT(*) AS n FROM typed GROUP BY ALL)"))
def class_distribution(spark, sf):
    """Count and share of each class per split."""
    return ST.class_distribution(ingest.tag_multiclass(ctx.typed(spark, sf)))


# ------------------------------------------------------------------ J: joins


@query("rank_join", "J1", O.sql(
    "SELECT v.feature, " + O.r("var", "variance") + ", CAST(dense_rank() OVER (ORDER BY " + O.rx("var") + " DESC) AS BIGINT) "
    "AS variance_rank, " + O.r("abs(c)", "importance") + ", CAST(dense_rank() OVER (ORDER BY "
    + O.rx("abs(c)") + " DESC) AS BIGINT) AS importance_rank FROM keep2 v JOIN (SELECT feature, "
    + corr_sql("value", "CAST(attack AS DOUBLE)") + " AS c FROM " + unpivot("features", FULL, ["attack"], TRAIN)
    + " GROUP BY feature HAVING " + corr_sql("value", "CAST(attack AS DOUBLE)") + " IS NOT NULL) c USING (feature)",
    _prep_sql("features", FULL), full=True))
def rank_join(spark, sf):
    """Dense ranks of variance and of |corr with label|, inner-joined on feature."""
    df = train_full(spark, sf)
    kept, med, _ = ST.prepare(df, FULL, scale=False)
    var = ST.variance_rank(ST.impute(df, med, kept), kept)
    imp = ST.corr_with_label(df, FULL).filter(F.col("corr").isNotNull()).select(
        "feature", registry_round(F.abs("corr")).alias("importance"))
    imp = imp.withColumn("importance_rank", F.dense_rank().over(Window.orderBy(F.desc("importance"))))
    return var.join(F.broadcast(imp), on="feature", how="inner")


def registry_round(c):
    from .registry import rounded
    return rounded(c)


@query("compare_importance", "J2", O.sql(
    "SELECT b.feature, " + O.r("b.var", "variance_core") + ", " + O.r("a.var", "variance_full") + ", "
    "CAST(b.rk AS BIGINT) AS rank_core, CAST(a.rk AS BIGINT) AS rank_full, CAST(a.rk - b.rk AS BIGINT) AS rank_delta "
    "FROM (SELECT feature, var, dense_rank() OVER (ORDER BY " + O.rx("var") + " DESC) AS rk FROM keep2) a JOIN "
    "(SELECT feature, var, dense_rank() OVER (ORDER BY " + O.rx("var") + " DESC) AS rk FROM keep2c) b USING (feature)",
    _prep_sql("features", FULL), _prep_sql("typed", CORE).replace("long AS", "longc AS").replace(
        "FROM long", "FROM longc").replace("prof AS", "profc AS").replace("FROM prof", "FROM profc").replace(
        "keep1 AS", "keep1c AS").replace("JOIN keep1 ", "JOIN keep1c ").replace("filled AS", "filledc AS").replace(
        "FROM filled", "FROM filledc").replace("keep2 AS", "keep2c AS").replace("JOIN keep2 ", "JOIN keep2c ").replace(
        "z AS (", "zc AS ("), full=True))
def compare_importance(spark, sf):
    """Core-mode vs full-mode variance ranks joined on feature, with the rank change."""
    df = train_full(spark, sf)
    out = []
    for tag, cols in (("core", CORE), ("full", FULL)):
        kept, med, _ = ST.prepare(df, cols, scale=False)
        v = ST.variance_rank(ST.impute(df, med, kept), kept)
        out.append(v.select("feature", F.col("variance").alias(f"variance_{tag}"),
                            F.col("variance_rank").alias(f"rank_{tag}")))
    j = out[0].join(out[1], on="feature", how="inner")
    return j.withColumn("rank_delta", F.col("rank_full") - F.col("rank_core"))


@query("compare_separability", "J3", O.sql(
    "SELECT a.attack_type, " + O.r("b.score", "score_core") + ", " + O.r("a.score", "score_full") + ", "
    + O.r("a.score - b.score", "score_delta") + " FROM sep2 a JOIN sepc2 b USING (attack_type)",
    _sep_sql("features", FULL), _sep_sql("features", CORE).replace("long AS", "longc AS").replace(
        "FROM long", "FROM longc").replace("prof AS", "profc AS").replace("FROM prof", "FROM profc").replace(
        "keep1 AS", "keep1c AS").replace("JOIN keep1 ", "JOIN keep1c ").replace("filled AS", "filledc AS").replace(
        "FROM filled", "FROM filledc").replace("keep2 AS", "keep2c AS").replace("JOIN keep2 ", "JOIN keep2c ").replace(
        "z AS (", "zc AS (").replace("FROM z ", "FROM zc ").replace("per AS", "perc AS").replace(
        "FROM per ", "FROM perc ").replace("sep AS", "sepc AS").replace("FROM sep)", "FROM sepc)").replace(
        "sep2 AS", "sepc2 AS"), full=True))
def compare_separability(spark, sf):
    """Separability per attack type, core vs full mode, joined with the change."""
    a = separability_frame(spark, sf, "full").select("attack_type", F.col("separability_score").alias("score_full"))
    b = separability_frame(spark, sf, "core").select("attack_type", F.col("separability_score").alias("score_core"))
    return a.join(b, on="attack_type").withColumn("score_delta", F.col("score_full") - F.col("score_core"))


@query("topk_semi", "J5", O.sql(
    f"SELECT packet_id, gocb_ref FROM typed WHERE split = 'train' AND gocb_ref IN {_TOP10}"))
def topk_semi(spark, sf):
    """Rows of the 10 busiest devices (broadcast left-semi join on a 10-row table)."""
    d = eda(spark, sf)
    return d.join(F.broadcast(ST.top_devices(d, 10).select("gocb_ref")), on="gocb_ref", how="left_semi").select(
        "packet_id", "gocb_ref")


# ------------------------------------------------------------------ W / T / P / U


@query("lag_diff", "W1", O.sql(
    f"SELECT packet_id, lag(st_num) OVER {O._W} AS prev_st_num, st_num - lag(st_num) OVER {O._W} AS st_diff "
    "FROM typed"))
def lag_diff(spark, sf):
    """Previous stNum of the device and the difference."""
    t = ctx.typed(spark, sf)
    s = stream.segmented(t, schema.DEVICE, "base_time", reuse=True)

    def build(d, w):
        return d.withColumn("prev_st_num", F.lag("st_num").over(w)).withColumn(
            "st_diff", F.col("st_num") - F.col("prev_st_num"))
    s = stream.windowed(s, schema.DEVICE, [F.col("base_time").asc_nulls_last(), F.col("packet_id")], build, 1)
    return s.select("packet_id", "prev_st_num", "st_diff")


@query("rolling", "W2", O.sql(
    "SELECT packet_id, " + O.r("jitter_rolling_std", "jitter") + ", " + O.r("sqNum_roll_mean", "roll10_mean")
    + ", " + O.r("rolling_sqNum_mean", "roll5_mean") + " FROM features JOIN newf USING (packet_id)",
    full=True, new=True))
def rolling(spark, sf):
    """Row frames of 10 (min 3), 10 (min 1) and 5 (min 1) rows."""
    a = ctx.full(spark, sf).select("packet_id", F.col("jitter_rolling_std").alias("jitter"))
    b = ctx.new(spark, sf).select("packet_id", F.col("sqNum_roll_mean").alias("roll10_mean"),
                                  F.col("rolling_sqNum_mean").alias("roll5_mean"))
    return a.join(b, on="packet_id")


@query("running", "W3", O.sql(
    "SELECT packet_id, event_id, msgs_since_last_event, " + O.r("time_since_last_event", "time_since_last_event")
    + " FROM features", full=True))
def running(spark, sf):
    """Running count of state changes, position in the event and time since its first row."""
    return ctx.full(spark, sf).select("packet_id", "event_id", "msgs_since_last_event", "time_since_last_event")


@query("first_row", "W4", O.sql(
    "SELECT attack_type, split, gocb_ref, packet_id, st_num, sq_num FROM (SELECT *, ROW_NUMBER() OVER "
    f"{O._W} AS rn FROM typed) WHERE rn = 1"))
def first_row(spark, sf):
    """First message of every device stream."""
    t = ctx.typed(spark, sf)
    s = stream.segmented(t, schema.DEVICE, "base_time", reuse=True)
    p = stream.position(s, schema.DEVICE, [F.col("base_time").asc_nulls_last(), F.col("packet_id")])
    return p.filter(F.col("_pos") == 0).select("attack_type", "split", "gocb_ref", "packet_id", "st_num", "sq_num")


@query("dense_rank_desc", "W5", O.sql(
    "SELECT attack_type, feature, CAST(dense_rank() OVER (PARTITION BY attack_type ORDER BY "
    + O.rx("abs(attack_mean - normal_mean)") + " DESC) AS BIGINT) AS diff_rank FROM "
    "(SELECT attack_type, feature, avg(value) FILTER (WHERE attack = 0) AS normal_mean, "
    "avg(value) FILTER (WHERE attack = 1) AS attack_mean FROM " + unpivot("typed", CORE, ["attack_type", "attack"],
                                                                       TRAIN, nulls=False)
    + " GROUP BY ALL) WHERE attack_mean IS NOT NULL AND normal_mean IS NOT NULL"))
def dense_rank_desc(spark, sf):
    """Dense rank of core features by |mean difference| within each attack type."""
    long = ST.long_values(eda(spark, sf), CORE, ["attack_type", "attack"]).filter(F.col("value").isNotNull())
    m = long.groupBy("attack_type", "feature").agg(
        F.avg(F.when(F.col("attack") == 0, F.col("value"))).alias("nm"),
        F.avg(F.when(F.col("attack") == 1, F.col("value"))).alias("am")).filter(
        F.col("nm").isNotNull() & F.col("am").isNotNull())
    d = registry_round(F.abs(F.col("am") - F.col("nm")))
    return m.select("attack_type", "feature",
                    F.dense_rank().over(Window.partitionBy("attack_type").orderBy(d.desc())).alias("diff_rank"))


SEQ_LEN = 30  # fixed value: sequence length of the sequence detector


@query("seq_label", "W6", O.sql(
    "SELECT packet_id, CAST(lab AS BIGINT) AS seq_label FROM (SELECT packet_id, max(attack) OVER (PARTITION BY "
    "attack_type, split, gocb_ref ORDER BY base_time NULLS LAST, packet_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) "
    f"AS lab, ROW_NUMBER() OVER {O._W} AS rn FROM typed) WHERE rn >= 30"))
def seq_label(spark, sf):
    """Label of each complete 30-message window: any attack in it (incomplete windows dropped)."""
    t = ctx.typed(spark, sf)
    s = stream.segmented(t, schema.DEVICE, "base_time", reuse=True)

    def build(d, w):
        return d.withColumn("seq_label", F.max("attack").over(w.rowsBetween(-(SEQ_LEN - 1), 0))).withColumn(
            "_full", F.lag(F.lit(1), SEQ_LEN - 1).over(w).isNotNull())
    s = stream.windowed(s, schema.DEVICE, [F.col("base_time").asc_nulls_last(), F.col("packet_id")], build,
                        SEQ_LEN - 1)
    return s.filter(F.col("_full")).select("packet_id", "seq_label")


@query("sequences", "W7", O.sql(
    "SELECT packet_id AS end_packet_id, " + O.r("s", "seq_sum") + ", " + O.r("f", "seq_first") + ", "
    + O.r("inter_arrival", "seq_last") + " FROM (SELECT packet_id, inter_arrival, "
    "SUM(inter_arrival) OVER w AS s, first_value(inter_arrival) OVER w AS f, COUNT(inter_arrival) OVER w AS n "
    "FROM features WINDOW w AS (PARTITION BY attack_type, split, gocb_ref ORDER BY base_time NULLS LAST, "
    "packet_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) WHERE n = 30", full=True))
def sequences(spark, sf):
    """Every overlapping run of 30 device gaps (as arrays), summarised by sum, first and last value."""
    t = ctx.full(spark, sf)
    s = stream.segmented(t, schema.DEVICE, "base_time", reuse=True)

    def build(d, w):
        return d.withColumn("_seq", F.collect_list("inter_arrival").over(w.rowsBetween(-(SEQ_LEN - 1), 0)))
    s = stream.windowed(s, schema.DEVICE, [F.col("base_time").asc_nulls_last(), F.col("packet_id")], build,
                        SEQ_LEN)
    s = s.filter(F.size("_seq") == SEQ_LEN)
    return s.select(F.col("packet_id").alias("end_packet_id"),
                    F.aggregate("_seq", F.lit(0.0), lambda a, x: a + x).alias("seq_sum"),
                    F.col("_seq")[0].alias("seq_first"), F.col("_seq")[SEQ_LEN - 1].alias("seq_last"))


@query("sort_multi", "T1", O.sql(
    "SELECT attack_type, feature, " + O.r("abs(attack_mean - normal_mean)", "mean_difference")
    + " FROM (SELECT attack_type, feature, avg(value) FILTER (WHERE attack = 0) AS normal_mean, "
    "avg(value) FILTER (WHERE attack = 1) AS attack_mean FROM "
    + unpivot("typed", CORE, ["attack_type", "attack"], TRAIN, nulls=False) + " GROUP BY ALL) "
    "ORDER BY attack_type, mean_difference DESC"))
def sort_multi(spark, sf):
    """Core feature mean differences sorted by attack type asc, difference desc."""
    long = ST.long_values(eda(spark, sf), CORE, ["attack_type", "attack"]).filter(F.col("value").isNotNull())
    m = long.groupBy("attack_type", "feature").agg(
        F.avg(F.when(F.col("attack") == 0, F.col("value"))).alias("nm"),
        F.avg(F.when(F.col("attack") == 1, F.col("value"))).alias("am"))
    return m.select("attack_type", "feature", F.abs(F.col("am") - F.col("nm")).alias("mean_difference")).orderBy(
        F.asc("attack_type"), F.desc("mean_difference"))


@query("topk", "T2", O.sql(
    "SELECT packet_id, " + O.r("heartbeat_interval_error", "heartbeat_interval_error")
    + " FROM features ORDER BY heartbeat_interval_error DESC NULLS LAST, packet_id LIMIT 10", full=True))
def topk(spark, sf):
    """Ten rows with the largest heartbeat error (TakeOrderedAndProject)."""
    return ctx.full(spark, sf).orderBy(F.desc_nulls_last("heartbeat_interval_error"), "packet_id").limit(10).select(
        "packet_id", "heartbeat_interval_error")


@query("per_group_topk", "T3", O.sql(
    "SELECT attack_type, feature, rk FROM (SELECT attack_type, feature, CAST(ROW_NUMBER() OVER (PARTITION BY "
    "attack_type ORDER BY " + O.rx("abs(attack_mean - normal_mean)") + " DESC, feature) AS BIGINT) AS rk FROM "
    "(SELECT attack_type, feature, avg(value) FILTER (WHERE attack = 0) AS normal_mean, "
    "avg(value) FILTER (WHERE attack = 1) AS attack_mean FROM "
    + unpivot("features", FULL, ["attack_type", "attack"], TRAIN, nulls=False)
    + " GROUP BY ALL) WHERE attack_mean IS NOT NULL AND normal_mean IS NOT NULL) WHERE rk <= 5", full=True))
def per_group_topk(spark, sf):
    """Top 5 full-mode features by |mean difference| per attack type."""
    long = ST.long_values(train_full(spark, sf), FULL, ["attack_type", "attack"]).filter(F.col("value").isNotNull())
    m = long.groupBy("attack_type", "feature").agg(
        F.avg(F.when(F.col("attack") == 0, F.col("value"))).alias("nm"),
        F.avg(F.when(F.col("attack") == 1, F.col("value"))).alias("am")).filter(
        F.col("nm").isNotNull() & F.col("am").isNotNull())
    d = registry_round(F.abs(F.col("am") - F.col("nm")))
    w = Window.partitionBy("attack_type").orderBy(d.desc(), F.col("feature"))
    return m.select("attack_type", "feature", F.row_number().over(w).alias("rk")).filter(F.col("rk") <= 5)


@query("sample_fixed", "P1", O.sql(
    "SELECT packet_id, st_num FROM typed ORDER BY md5(CAST(packet_id AS VARCHAR)) LIMIT 500"))
def sample_fixed(spark, sf):
    """A fixed-size sample: the 500 rows with the smallest md5 of their id (same in any engine)."""
    return SA.sample_fixed(ctx.typed(spark, sf), 500).select("packet_id", "st_num")


@query("balance_classes", "P2", O.sql(
    "SELECT packet_id, attack_type, CAST(attack AS BIGINT) AS attack FROM (SELECT *, ROW_NUMBER() OVER "
    "(PARTITION BY attack_type ORDER BY md5(CAST(packet_id AS VARCHAR))) AS rn FROM typed WHERE split = 'test' "
    "AND attack = 1) WHERE rn <= (SELECT min(c) FROM (SELECT COUNT(*) AS c FROM typed WHERE split = 'test' "
    "AND attack = 1 GROUP BY attack_type)) UNION ALL SELECT packet_id, attack_type, CAST(attack AS BIGINT) "
    "FROM typed WHERE split = 'test' AND attack = 0"))
def balance_classes(spark, sf):
    """Test set with every normal row and each attack type cut to the smallest type's count."""
    t = ctx.typed(spark, sf).filter(F.col("split") == "test")
    return SA.balance_classes(t).select("packet_id", "attack_type", "attack")


@query("holdout_split", "P3", O.sql(
    "SELECT packet_id, CASE WHEN CAST(('0x' || substr(md5(CAST(packet_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10 = 0 "
    "THEN 'holdout' ELSE 'fit' END AS random_part, CASE WHEN ROW_NUMBER() OVER (ORDER BY packet_id) - 1 < "
    "floor(0.8 * COUNT(*) OVER ()) THEN 'first80' ELSE 'last20' END AS order_part FROM typed "
    "WHERE split = 'train'"))
def holdout_split(spark, sf):
    """90/10 split by id hash and 80/20 split by row order (train)."""
    t = ctx.typed(spark, sf).filter(F.col("split") == "train")
    return SA.holdout_split(t, "packet_id")


@query("union_all", "U1", O.sql(
    "SELECT split, COUNT(*) AS n FROM (SELECT split FROM typed WHERE split = 'train' UNION ALL "
    "SELECT split FROM typed WHERE split = 'test') GROUP BY split"))
def union_all(spark, sf):
    """Train and test stacked (by name) and counted."""
    t = ctx.typed(spark, sf)
    u = t.filter(F.col("split") == "train").unionByName(t.filter(F.col("split") == "test"))
    return u.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_devices", "U2", O.sql("SELECT DISTINCT gocb_ref, attack_type FROM typed"))
def distinct_devices(spark, sf):
    return ctx.typed(spark, sf).select("gocb_ref", "attack_type").distinct()
