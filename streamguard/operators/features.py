"""Per-device stream features (F1-F23, "full" mode; G1-G11, "new" mode).

All look-back features of one mode are evaluated with one window spec over
(attack_type, split, gocb_ref, _seg), so the plan has one exchange and one sort;
see ``operators.stream`` for how segment edges are patched.  Null handling
follows the reference's pandas semantics (SURVEY 2.15 N2-N4): a missing
previous value makes ``!=`` true, comparisons with a missing value are false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .. import schema
from ..functions import parsing as P
from ..functions.numeric import EPS
from ..functions.quantiles import exact_quantiles
from . import stream

# Fixed values of the protocol rules.
RESET_SET = [0, 1]          # sqNum values accepted after a state change
JITTER_ROWS = 10            # rolling window of the jitter feature
JITTER_MIN = 3              # minimum non-null inter-arrivals for the jitter
HB_TOL_SHARE = 0.05         # heartbeat tolerance: 5 % of TTL/2 ...
HB_TOL_ABS = 0.005          # ... plus 5 ms
ROLL_LONG = 10              # "new" mode rolling mean/std length
ROLL_SHORT = 5              # "new" mode rolling sqNum mean length
N_BITS = 8                  # leading bit-string characters turned into columns

FULL_LOOKBACK = JITTER_ROWS  # jitter over 10 inter-arrivals, each one row back
NEW_LOOKBACK = ROLL_LONG

STATUS_COLS = ["boolean_1", "boolean_2", "boolean_3"]


def _d(c: Column) -> Column:
    return c.cast("double")


def _flag(cond: Column) -> Column:
    """pandas ``(cond).astype(float)``: a null comparison is false."""
    return F.coalesce(cond, F.lit(False)).cast("double")


def changed(c: Column, w: WindowSpec) -> Column:
    """``x != previous`` with pandas null semantics (null != anything is true); first row null."""
    prev = F.lag(c).over(w)
    first = F.lag(F.lit(1)).over(w).isNull()
    return F.when(first, F.lit(None).cast("double")).otherwise(
        F.coalesce(c != prev, F.lit(True)).cast("double"))


def length_col() -> Column:
    return F.coalesce(F.col("frame_len"), F.col("length")).cast("double")


def _build_full(df: DataFrame, w: WindowSpec) -> DataFrame:
    bt = F.col("base_time")
    ln = length_col()
    ttl = _d(F.col("ttl_ms"))
    sq = F.col("sq_num")
    roll = w.rowsBetween(-(JITTER_ROWS - 1), 0)
    first = F.lag(F.lit(1)).over(w).isNull()

    ia = F.coalesce(bt - F.lag(bt).over(w),
                    F.when(bt.isNull(), F.coalesce(F.col("delta_captured"), F.col("delta_displayed"))))
    df = df.withColumn("inter_arrival", ia)
    ia = F.col("inter_arrival")
    sq_d = _d(sq - F.lag(sq).over(w))
    st_d = _d(F.col("st_num") - F.lag(F.col("st_num")).over(w))
    t_text = F.coalesce(F.col("t").cast("string"), F.lit("nan"))
    status = F.greatest(*[F.coalesce(changed(F.col(c), w), F.lit(0.0))
                          for c in STATUS_COLS + ["bit_string"]])
    df = df.select(
        "*",
        F.when(F.count(ia).over(roll) >= JITTER_MIN, F.stddev_samp(ia).over(roll)).alias("jitter_rolling_std"),
        F.try_divide(F.lit(1.0), ia + EPS).alias("msg_rate"),
        F.try_divide(ln, ia + EPS).alias("byte_rate"),
        _flag(ia > ttl / 1000.0).alias("ttl_violation"),
        (ttl / 1000.0 - ia).alias("ttl_margin"),
        sq_d.alias("sqNum_delta"),
        _flag(sq_d != 1).alias("sqNum_jump"),
        st_d.alias("stNum_delta"),
        _flag(st_d != 0).alias("stNum_change"),
        (ln - F.lag(ln).over(w)).alias("length_delta"),
        F.when(first, F.lit(None).cast("double")).otherwise(
            F.coalesce(t_text != F.lag(t_text).over(w), F.lit(True)).cast("double")).alias("t_change"),
        F.when(first, F.lit(None).cast("double")).otherwise(status).alias("status_bit_change"),
        _d(F.col("conf_rev") - F.lag(F.col("conf_rev")).over(w)).alias("confRev_delta"),
        changed(F.col("go_id"), w).alias("cfg_change_goID"),
        changed(F.col("dat_set"), w).alias("cfg_change_datSet"),
        changed(F.col("conf_rev"), w).alias("cfg_change_confRev"),
    )
    return df


def _rules(df: DataFrame) -> DataFrame:
    """Row-local rule features on top of the look-back columns."""
    st = F.col("stNum_change")
    sq_reset = F.coalesce(F.col("sq_num").isin(*RESET_SET), F.lit(False))
    sbc = F.col("status_bit_change")
    ttl_half = _d(F.col("ttl_ms")) / 2000.0
    hb_err = F.abs(F.col("inter_arrival") - ttl_half)
    cfg = (F.coalesce(F.col("cfg_change_goID"), F.lit(0.0)) + F.coalesce(F.col("cfg_change_datSet"), F.lit(0.0))
           + F.coalesce(F.col("cfg_change_confRev"), F.lit(0.0)))
    return df.select(
        "*",
        _flag((st == 1.0) & sq_reset).alias("sq_reset_on_st_change"),
        (F.col("msg_rate") * st).alias("event_rate_spike"),
        F.try_divide(F.col("bitstring_bitcount"), length_col() * 8.0 + EPS).alias("bit_density"),
        st.alias("st_change"),
        _flag((st == 1.0) & sq_reset).alias("sq_reset_expected"),
        _flag((st == 1.0) & ~sq_reset).alias("sq_reset_violation"),
        F.when(F.col("t_change").isNull(), F.lit(None).cast("double")).otherwise(
            (F.col("t_change") != st).cast("double")).alias("t_st_consistency_violation"),
        F.when(sbc.isNull(), F.lit(None).cast("double")).otherwise(
            ((st == 1.0) & (sbc != 1.0)).cast("double")).alias("status_change_missing_on_event"),
        ttl_half.alias("ttl_half"),
        hb_err.alias("heartbeat_interval_error"),
        _flag(hb_err <= HB_TOL_SHARE * ttl_half + HB_TOL_ABS).alias("heartbeat_within_tol"),
        _flag((st == 0.0) & (F.col("sqNum_delta") == 1)).alias("sq_inc_expected"),
        _flag((st == 0.0) & ~F.coalesce(F.col("sqNum_delta") == 1, F.lit(False))).alias(
            "sq_inc_violation_when_no_event"),
        F.when(sbc.isNull(), F.lit(None).cast("double")).otherwise(
            ((st == 0.0) & (sbc == 1.0)).cast("double")).alias("status_change_violation_on_heartbeat"),
        _flag(F.col("stNum_delta") > 1).alias("stNum_jump_gt1"),
        _flag((st == 0.0) & sq_reset).alias("sq_reset_without_st_change"),
        _flag(F.col("confRev_delta") != 0).alias("confRev_change"),
        _flag((st == 1.0) & (cfg > 0)).alias("config_change_violation_on_event"),
    )


def full_order() -> list[Column]:
    return [F.col("base_time").asc_nulls_last(), F.col("packet_id").asc()]


def engineer_full(typed: DataFrame, target_rows: int | None = stream.DEFAULT_TARGET_ROWS) -> DataFrame:
    """F1-F23 on typed packets.  Keeps the stream columns ``_seg``/``_lp``/``_cnt``."""
    df = stream.segmented(typed, schema.DEVICE, "base_time", target_rows, reuse=True)
    df = stream.windowed(df, schema.DEVICE, full_order(), _build_full, FULL_LOOKBACK)
    df = _rules(df)
    # Event numbering runs over the whole file, in (gocb_ref, time) order.
    df = stream.runs(df, schema.DEVICE, full_order(), F.col("st_change"), F.col("base_time"), "_ev",
                     offset_keys=schema.FILE, offset_order=["gocb_ref"])
    return (df.withColumn("event_id", F.col("_ev_id"))
            .withColumn("msgs_since_last_event", F.col("_ev_pos"))
            .withColumn("time_since_last_event", F.col("base_time") - F.col("_ev_start"))
            .withColumn("event_msg_rank", F.col("_ev_pos").cast("double"))
            .drop("_ev_id", "_ev_pos", "_ev_start"))


# ---------------------------------------------------------------- "new" mode


def rolling_moments(x: Column, w: WindowSpec, rows: int) -> tuple[Column, Column]:
    """Mean and sample std over the last ``rows`` rows (min 1 value, std of one value -> 0).

    Computed on offsets from the current value (lag(x, k) - x), so large
    magnitudes such as epoch seconds keep their precision.
    """
    d = [F.lit(0.0).cast("double") if k == 0 else F.lag(x, k).over(w) - x for k in range(rows)]
    d[0] = F.when(x.isNotNull(), F.lit(0.0))
    n = sum_cols([d_k.isNotNull().cast("double") for d_k in d])
    s1 = sum_cols([F.coalesce(d_k, F.lit(0.0)) for d_k in d])
    s2 = sum_cols([F.coalesce(d_k * d_k, F.lit(0.0)) for d_k in d])
    mean = F.when(n > 0, x + s1 / n)
    var = F.when(n > 1, (s2 - s1 * s1 / n) / (n - 1))
    std = F.coalesce(F.sqrt(F.greatest(var, F.lit(0.0))), F.lit(0.0))
    return mean, std


def sum_cols(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def _build_new(df: DataFrame, w: WindowSpec) -> DataFrame:
    long = w.rowsBetween(-(ROLL_LONG - 1), 0)
    short = w.rowsBetween(-(ROLL_SHORT - 1), 0)
    sq = _d(F.col("sq_num"))
    st = _d(F.col("st_num"))
    tm = F.col("time_s")
    return df.select(
        "*",
        F.coalesce(st - F.lag(st).over(w), F.lit(0.0)).alias("stNum_diff"),
        F.coalesce(sq - F.lag(sq).over(w), F.lit(0.0)).alias("sqNum_diff"),
        F.coalesce(tm - F.lag(tm).over(w), F.lit(0.0)).alias("time_between_msgs"),
        F.avg(sq).over(long).alias("sqNum_roll_mean"),
        F.coalesce(F.stddev_samp(sq).over(long), F.lit(0.0)).alias("sqNum_roll_std"),
        rolling_moments(tm, w, ROLL_LONG)[0].alias("Time_roll_mean"),
        rolling_moments(tm, w, ROLL_LONG)[1].alias("Time_roll_std"),
        (F.col("precise_time") - F.lag(F.col("precise_time")).over(w)).alias("_delta_time"),
        F.avg(sq).over(short).alias("rolling_sqNum_mean"),
    )


def time_parts(t: Column) -> list[Column]:
    """G1: calendar parts of ``t`` (UTC); Monday = 0."""
    ts = t.cast("string").try_cast("timestamp")
    us = F.unix_micros(ts)
    return [
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        F.second(ts).alias("second"),
        F.pmod(us, F.lit(1_000_000)).alias("microsecond"),
        F.weekday(ts).alias("dayofweek"),
        F.floor(us / F.lit(1_000_000)).alias("unix_time"),
    ]


def bit_text_features(bit: Column) -> list[Column]:
    """Text of the bit string (missing -> 'nan'), its length, 1/0 counts, first 8 characters."""
    s = F.coalesce(bit.cast("string"), F.lit("nan"))
    cols = [
        F.length(s).alias("bit_len"),
        (F.length(s) - F.length(F.replace(s, F.lit("1"), F.lit("")))).alias("bit_ones"),
        (F.length(s) - F.length(F.replace(s, F.lit("0"), F.lit("")))).alias("bit_zeros"),
    ]
    for i in range(N_BITS):
        ch = F.substring(s, i + 1, 1)
        cols.append(F.when(ch.isin("0", "1"), ch.cast("int")).otherwise(F.lit(0)).alias(f"bit_{i}"))
    return cols


def bool_stats(df: DataFrame) -> list[Column]:
    """Counts over the three flags."""
    b = [F.col(c) for c in STATUS_COLS]
    n_true = sum(F.coalesce((x == 1).cast("int"), F.lit(0)) for x in b)
    n_false = sum(F.coalesce((x == 0).cast("int"), F.lit(0)) for x in b)
    return [
        *[F.col(c).alias(f"bool_{i + 1}") for i, c in enumerate(STATUS_COLS)],
        n_true.alias("bool_true_count"),
        n_false.alias("bool_false_count"),
        (n_true / (n_false + 1)).alias("bool_ratio"),
        (n_true > 0).cast("int").alias("bool_has_true"),
        (n_true == 0).cast("int").alias("bool_all_false"),
    ]


def new_order() -> list[Column]:
    return [F.col("_t_epoch").asc_nulls_last(), F.col("packet_id").asc()]


def engineer_new(typed: DataFrame, target_rows: int | None = stream.DEFAULT_TARGET_ROWS,
                 drop_core: bool = False) -> DataFrame:
    """G1-G10 ordered by (gocb_ref, t); ``drop_core`` applies G11."""
    df = typed.drop(stream.SEG, stream.LP, stream.CNT)
    parts = time_parts(F.col("t"))
    df = df.select("*", *parts, *bool_stats(df), *bit_text_features(F.col("bit_string")),
                   P.epoch_seconds(F.col("t")).alias("_t_epoch"))
    df = df.withColumn("precise_time", F.col("unix_time") + F.col("microsecond") / 1e6)
    df = stream.segmented(df, schema.DEVICE, "_t_epoch", target_rows)
    df = stream.windowed(df, schema.DEVICE, new_order(), _build_new, NEW_LOOKBACK)
    med = exact_quantiles(df, "precise_time", schema.FILE, [0.5], prefix="_med")
    df = df.join(med, on=schema.FILE, how="left")
    ttl_exp = _d(F.col("ttl_ms")) / 2000
    df = df.select(
        "*",
        (F.col("stNum_diff") > 0).cast("int").alias("stNum_increased"),
        (F.col("sqNum_diff") < 0).cast("int").alias("sqNum_reset"),
        ttl_exp.alias("expected_interval"),
        F.abs(F.col("time_between_msgs") - ttl_exp).alias("time_deviation"),
        (_d(F.col("sq_num")) / (_d(F.col("st_num")) + 1)).alias("sq_st_ratio"),
        F.coalesce(F.col("_delta_time"), F.col("_med0")).alias("delta_time"),
        F.col("sqNum_diff").alias("delta_sqNum"),
    ).drop("_delta_time", "_med0", "_t_epoch")
    if drop_core:
        df = df.drop(*schema.NEW_MODE_DROPS)
    return df
