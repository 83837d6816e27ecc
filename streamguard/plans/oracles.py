"""DuckDB text for the oracle side of every registered query.

``PACKETS_CTE`` is the DuckDB form of ``sources.packets.packets``; each oracle
query is ``WITH <ctes> <select>``.  Floats are rounded to ``DIGITS`` decimals
on both sides (``functions.numeric.rounded``).
"""

from __future__ import annotations

DIGITS = 6

PACKETS_CTE = """
e AS (
  SELECT event_id, user_id, ts, event_type, value,
         epoch_us(ts) AS us, CAST(json_extract_string(props,'$.k') AS INT) AS k
  FROM events),
o AS (
  SELECT *, CAST(SUM(CASE WHEN event_type IN ('signup','purchase') THEN 1 ELSE 0 END)
         OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS ev FROM e),
p AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, ev ORDER BY ts, event_id) - 1 AS rn,
         MIN(ts) OVER (PARTITION BY user_id, ev) AS t0 FROM o),
packets AS (
SELECT event_id AS packet_id,
       CASE user_id % 4 WHEN 0 THEN 'replay' WHEN 1 THEN 'masquerade'
                        WHEN 2 THEN 'injection' ELSE 'poisoning' END AS attack_type,
       CASE WHEN user_id % 8 < 4 THEN 'train' ELSE 'test' END AS split,
       concat('IED', CAST(user_id AS VARCHAR)) AS gocb_ref,
       us / 1000000.0e0 AS time_s,
       t0 AS t,
       CAST(1 + ev + CASE WHEN event_id % 97 = 0 THEN 900 ELSE 0 END AS BIGINT) AS st_num,
       CAST(rn + CASE WHEN event_id % 37 = 0 THEN 5 ELSE 0 END AS BIGINT) AS sq_num,
       CAST(CASE WHEN event_type = 'error' THEN 10
                 ELSE 40000000 * (1 + k % 2) END AS BIGINT) AS ttl_ms,
       CAST(130 + k % 40 AS BIGINT) AS length,
       CASE WHEN k % 10 = 0 THEN 'True' WHEN k % 10 = 1 THEN 'False,True'
            WHEN k % 10 < 5 THEN 'false, TRUE,False,1' ELSE 'True,no,off' END AS boolean_raw,
       CASE WHEN event_id % 5 = 0 THEN NULL WHEN k % 4 = 0 THEN '40' ELSE '80' END AS bit_string,
       concat('h', CAST(user_id % 50 AS VARCHAR)) AS source,
       concat('h', CAST(k % 20 AS VARCHAR)) AS destination,
       value,
       CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INT) AS attack
FROM p)"""


def _flag_sql(i: int) -> str:
    tok = (f"regexp_replace(string_split(lower(regexp_replace(boolean_raw, '^\\s+|\\s+$', '', 'g')), ',')[{i + 1}],"
           " '^\\s+|\\s+$', '', 'g')")
    return (f"CAST(CASE WHEN {tok} IN ('true','1','yes','y','on') THEN 1.0 "
            f"WHEN {tok} IN ('false','0','no','n','off') THEN 0.0 END AS DOUBLE)")


_HEX = ("CASE WHEN regexp_full_match(replace(lower(regexp_replace(bit_string, '^\\s+|\\s+$', '', 'g')), '0x', ''),"
        " '[0-9a-f]+') THEN replace(lower(regexp_replace(bit_string, '^\\s+|\\s+$', '', 'g')), '0x', '') END")


def _count_class(s: str, cls: str) -> str:
    return f"(length({s}) - length(regexp_replace({s}, '{cls}', '', 'g')))"


POPCOUNT = ("CAST(" + " + ".join([
    _count_class(_HEX, "[1248]"), "2 * " + _count_class(_HEX, "[3569ac]"),
    "3 * " + _count_class(_HEX, "[7bde]"), "4 * " + _count_class(_HEX, "f")]) + " AS DOUBLE)")

TYPED_CTE = f"""
typed AS (
  SELECT packet_id, attack_type, split, gocb_ref, time_s, CAST(t AS VARCHAR) AS t, st_num, sq_num, ttl_ms,
         length, boolean_raw, bit_string, source, destination, value, attack,
         CAST(NULL AS BIGINT) AS frame_len, CAST(1 + CAST(packet_id % 211 = 0 AS INT) AS BIGINT) AS conf_rev,
         CAST(NULL AS DOUBLE) AS epoch_time, CAST(NULL AS DOUBLE) AS arrival_time,
         CAST(NULL AS BIGINT) AS frame_len_stored, CAST(NULL AS DOUBLE) AS delta_captured,
         CAST(NULL AS DOUBLE) AS delta_displayed, CAST(NULL AS DOUBLE) AS time_since_first,
         CAST(NULL AS DOUBLE) AS time_shift,
         CAST(NULL AS VARCHAR) AS go_id, CAST(NULL AS VARCHAR) AS dat_set,
         {_flag_sql(0)} AS boolean_1, {_flag_sql(1)} AS boolean_2, {_flag_sql(2)} AS boolean_3,
         TRY_CAST(bit_string AS DOUBLE) AS bitstring_numeric,
         {POPCOUNT} AS bitstring_bitcount,
         time_s AS base_time
  FROM packets)"""

_W = "(PARTITION BY attack_type, split, gocb_ref ORDER BY base_time NULLS LAST, packet_id)"
_W10 = ("(PARTITION BY attack_type, split, gocb_ref ORDER BY base_time NULLS LAST, packet_id "
        "ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)")


def _chg(c: str) -> str:
    return (f"CASE WHEN lag(1) OVER {_W} IS NULL THEN NULL "
            f"ELSE CAST(coalesce({c} <> lag({c}) OVER {_W}, true) AS DOUBLE) END")


FULL_CTE = f"""
f1 AS (
  SELECT *, base_time - lag(base_time) OVER {_W} AS inter_arrival,
         CAST(sq_num - lag(sq_num) OVER {_W} AS DOUBLE) AS sqNum_delta,
         CAST(st_num - lag(st_num) OVER {_W} AS DOUBLE) AS stNum_delta,
         CAST(coalesce(frame_len, length) AS DOUBLE) - lag(CAST(coalesce(frame_len, length) AS DOUBLE)) OVER {_W}
           AS length_delta,
         CASE WHEN lag(1) OVER {_W} IS NULL THEN NULL ELSE CAST(coalesce(coalesce(t, 'nan') <>
           lag(coalesce(t, 'nan')) OVER {_W}, true) AS DOUBLE) END AS t_change,
         CASE WHEN lag(1) OVER {_W} IS NULL THEN NULL ELSE greatest(
           coalesce({_chg('boolean_1')}, 0.0), coalesce({_chg('boolean_2')}, 0.0),
           coalesce({_chg('boolean_3')}, 0.0), coalesce({_chg('bit_string')}, 0.0)) END AS status_bit_change,
         CAST(conf_rev - lag(conf_rev) OVER {_W} AS DOUBLE) AS confRev_delta,
         {_chg('go_id')} AS cfg_change_goID, {_chg('dat_set')} AS cfg_change_datSet,
         {_chg('conf_rev')} AS cfg_change_confRev
  FROM typed),
f2 AS (
  SELECT *,
         CASE WHEN count(inter_arrival) OVER {_W10} >= 3 THEN stddev_samp(inter_arrival) OVER {_W10} END
           AS jitter_rolling_std,
         1.0 / (inter_arrival + 1e-6) AS msg_rate,
         CAST(coalesce(frame_len, length) AS DOUBLE) / (inter_arrival + 1e-6) AS byte_rate,
         CAST(coalesce(inter_arrival > ttl_ms / 1000.0, false) AS DOUBLE) AS ttl_violation,
         ttl_ms / 1000.0 - inter_arrival AS ttl_margin,
         CAST(coalesce(sqNum_delta <> 1, false) AS DOUBLE) AS sqNum_jump,
         CAST(coalesce(stNum_delta <> 0, false) AS DOUBLE) AS stNum_change
  FROM f1),
f3 AS (
  SELECT *,
         CAST(stNum_change = 1.0 AND coalesce(sq_num IN (0, 1), false) AS DOUBLE) AS sq_reset_on_st_change,
         msg_rate * stNum_change AS event_rate_spike,
         bitstring_bitcount / (CAST(coalesce(frame_len, length) AS DOUBLE) * 8.0 + 1e-6) AS bit_density,
         stNum_change AS st_change,
         CAST(stNum_change = 1.0 AND coalesce(sq_num IN (0, 1), false) AS DOUBLE) AS sq_reset_expected,
         CAST(stNum_change = 1.0 AND NOT coalesce(sq_num IN (0, 1), false) AS DOUBLE) AS sq_reset_violation,
         CASE WHEN t_change IS NULL THEN NULL ELSE CAST(t_change <> stNum_change AS DOUBLE) END
           AS t_st_consistency_violation,
         CASE WHEN status_bit_change IS NULL THEN NULL
              ELSE CAST(stNum_change = 1.0 AND status_bit_change <> 1.0 AS DOUBLE) END
           AS status_change_missing_on_event,
         ttl_ms / 2000.0 AS ttl_half,
         abs(inter_arrival - ttl_ms / 2000.0) AS heartbeat_interval_error,
         CAST(coalesce(abs(inter_arrival - ttl_ms / 2000.0) <= 0.05 * (ttl_ms / 2000.0) + 0.005, false) AS DOUBLE)
           AS heartbeat_within_tol,
         CAST(coalesce(stNum_change = 0.0 AND sqNum_delta = 1, false) AS DOUBLE) AS sq_inc_expected,
         CAST(stNum_change = 0.0 AND NOT coalesce(sqNum_delta = 1, false) AS DOUBLE)
           AS sq_inc_violation_when_no_event,
         CASE WHEN status_bit_change IS NULL THEN NULL
              ELSE CAST(stNum_change = 0.0 AND status_bit_change = 1.0 AS DOUBLE) END
           AS status_change_violation_on_heartbeat,
         CAST(coalesce(stNum_delta > 1, false) AS DOUBLE) AS stNum_jump_gt1,
         CAST(stNum_change = 0.0 AND coalesce(sq_num IN (0, 1), false) AS DOUBLE) AS sq_reset_without_st_change,
         CAST(coalesce(confRev_delta <> 0, false) AS DOUBLE) AS confRev_change,
         CAST(stNum_change = 1.0 AND coalesce(cfg_change_goID, 0) + coalesce(cfg_change_datSet, 0)
              + coalesce(cfg_change_confRev, 0) > 0 AS DOUBLE) AS config_change_violation_on_event,
         CAST(SUM(stNum_change) OVER (PARTITION BY attack_type, split
              ORDER BY gocb_ref, base_time NULLS LAST, packet_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS event_id
  FROM f2),
features AS (
  SELECT *,
         ROW_NUMBER() OVER (PARTITION BY attack_type, split, gocb_ref, event_id
                            ORDER BY base_time NULLS LAST, packet_id) - 1 AS msgs_since_last_event,
         base_time - first_value(base_time) OVER (PARTITION BY attack_type, split, gocb_ref, event_id
                            ORDER BY base_time NULLS LAST, packet_id) AS time_since_last_event,
         CAST(ROW_NUMBER() OVER (PARTITION BY attack_type, split, gocb_ref, event_id
                            ORDER BY base_time NULLS LAST, packet_id) - 1 AS DOUBLE) AS event_msg_rank
  FROM f3)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_WN = "(PARTITION BY attack_type, split, gocb_ref ORDER BY t_epoch NULLS LAST, packet_id)"


def _wn(k: int) -> str:
    return (f"(PARTITION BY attack_type, split, gocb_ref ORDER BY t_epoch NULLS LAST, packet_id "
            f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)")


_BITS = ",\n".join(
    f"CAST(CASE WHEN substr(coalesce(bit_string, 'nan'), {i + 1}, 1) IN ('0', '1') "
    f"THEN CAST(substr(coalesce(bit_string, 'nan'), {i + 1}, 1) AS INT) ELSE 0 END AS BIGINT) AS bit_{i}"
    for i in range(8))

def _roll_parts(x: str, rows: int) -> tuple[str, str, str]:
    d = [f"(CASE WHEN {x} IS NOT NULL THEN 0.0 END)"] + [f"(lag({x}, {k}) OVER {_WN} - {x})" for k in range(1, rows)]
    n = " + ".join(f"CAST({e} IS NOT NULL AS DOUBLE)" for e in d)
    s1 = " + ".join(f"coalesce({e}, 0.0)" for e in d)
    s2 = " + ".join(f"coalesce({e} * {e}, 0.0)" for e in d)
    return f"({n})", f"({s1})", f"({s2})"


def _roll_mean(x: str, rows: int) -> str:
    n, s1, _ = _roll_parts(x, rows)
    return f"(CASE WHEN {n} > 0 THEN {x} + {s1} / {n} END)"


def _roll_std(x: str, rows: int) -> str:
    n, s1, s2 = _roll_parts(x, rows)
    return f"coalesce(sqrt(greatest(CASE WHEN {n} > 1 THEN ({s2} - {s1} * {s1} / {n}) / ({n} - 1) END, 0.0)), 0.0)"


NEW_CTE = f"""
n0 AS (
  SELECT *, TRY_CAST(t AS TIMESTAMP) AS tt, epoch_us(TRY_CAST(t AS TIMESTAMP)) / 1000000.0 AS t_epoch
  FROM typed),
n1 AS (
  SELECT *,
    CAST(day(tt) AS BIGINT) AS day, CAST(hour(tt) AS BIGINT) AS hour, CAST(second(tt) AS BIGINT) AS second,
    CAST(epoch_us(tt) % 1000000 AS BIGINT) AS microsecond, CAST(isodow(tt) - 1 AS BIGINT) AS dayofweek,
    CAST(floor(epoch_us(tt) / 1000000) AS BIGINT) AS unix_time,
    boolean_1 AS bool_1, boolean_2 AS bool_2, boolean_3 AS bool_3,
    CAST(coalesce(CAST(boolean_1 = 1 AS INT), 0) + coalesce(CAST(boolean_2 = 1 AS INT), 0)
         + coalesce(CAST(boolean_3 = 1 AS INT), 0) AS BIGINT) AS bool_true_count,
    CAST(coalesce(CAST(boolean_1 = 0 AS INT), 0) + coalesce(CAST(boolean_2 = 0 AS INT), 0)
         + coalesce(CAST(boolean_3 = 0 AS INT), 0) AS BIGINT) AS bool_false_count,
    CAST(length(coalesce(bit_string, 'nan')) AS BIGINT) AS bit_len,
    CAST(length(coalesce(bit_string, 'nan')) - length(replace(coalesce(bit_string, 'nan'), '1', '')) AS BIGINT)
      AS bit_ones,
    CAST(length(coalesce(bit_string, 'nan')) - length(replace(coalesce(bit_string, 'nan'), '0', '')) AS BIGINT)
      AS bit_zeros,
    {_BITS}
  FROM n0),
n2 AS (
  SELECT *,
    bool_true_count / (bool_false_count + 1) AS bool_ratio,
    CAST(bool_true_count > 0 AS BIGINT) AS bool_has_true,
    CAST(bool_true_count = 0 AS BIGINT) AS bool_all_false,
    unix_time + microsecond / 1e6 AS precise_time,
    coalesce(CAST(st_num AS DOUBLE) - lag(CAST(st_num AS DOUBLE)) OVER {_WN}, 0.0) AS stNum_diff,
    coalesce(CAST(sq_num AS DOUBLE) - lag(CAST(sq_num AS DOUBLE)) OVER {_WN}, 0.0) AS sqNum_diff,
    coalesce(time_s - lag(time_s) OVER {_WN}, 0.0) AS time_between_msgs,
    avg(CAST(sq_num AS DOUBLE)) OVER {_wn(10)} AS sqNum_roll_mean,
    coalesce(stddev_samp(CAST(sq_num AS DOUBLE)) OVER {_wn(10)}, 0.0) AS sqNum_roll_std,
    {_roll_mean('time_s', 10)} AS Time_roll_mean,
    {_roll_std('time_s', 10)} AS Time_roll_std,
    avg(CAST(sq_num AS DOUBLE)) OVER {_wn(5)} AS rolling_sqNum_mean
  FROM n1),
newf AS (
  SELECT *,
    CAST(stNum_diff > 0 AS BIGINT) AS stNum_increased,
    CAST(sqNum_diff < 0 AS BIGINT) AS sqNum_reset,
    ttl_ms / 2000 AS expected_interval,
    abs(time_between_msgs - ttl_ms / 2000) AS time_deviation,
    CAST(sq_num AS DOUBLE) / (CAST(st_num AS DOUBLE) + 1) AS sq_st_ratio,
    coalesce(precise_time - lag(precise_time) OVER {_WN},
             median(precise_time) OVER (PARTITION BY attack_type, split)) AS delta_time,
    sqNum_diff AS delta_sqNum
  FROM n2)"""

BASE = [PACKETS_CTE, TYPED_CTE]


def sql(select: str, *extra: str, full: bool = False, new: bool = False) -> str:
    ctes = list(BASE)
    if full:
        ctes.append(FULL_CTE)
    if new:
        ctes.append(NEW_CTE)
    ctes.extend(extra)
    return with_ctes(*ctes) + select


SIG = 10


def rx(expr: str, digits: int = DIGITS) -> str:
    """Rounded double, same rule as ``registry.rounded``: decimals, then significant digits."""
    x = f"CAST({expr} AS DOUBLE)"
    # half-up on the decimal value, as Spark's round does
    d = (f"(CASE WHEN abs({x}) < 1e20 THEN CAST(ROUND(CAST({x} AS DECIMAL(38, 12)), {digits}) AS DOUBLE) "
         f"ELSE {x} END)")
    k = f"({SIG - 1} - floor(log10(abs({d}))))"
    return (f"(CASE WHEN {d} IS NULL OR {d} = 0 OR isnan({d}) THEN {d} "
            f"WHEN {k} >= 0 THEN floor({d} * pow(10.0, {k}) + 0.5) / pow(10.0, {k}) "
            f"ELSE floor({d} / pow(10.0, -{k}) + 0.5) * pow(10.0, -{k}) END)")


def r(expr: str, name: str, digits: int = DIGITS) -> str:
    """Rounded double output column."""
    return f"{rx(expr, digits)} AS {name}"


def b(expr: str, name: str) -> str:
    """BIGINT output column."""
    return f"CAST({expr} AS BIGINT) AS {name}"
