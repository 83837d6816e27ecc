"""Registered queries: sources, typing and stream features (S*, C*, F*, G*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema
from ..functions import parsing as P
from ..operators import features as FE
from ..operators import stream
from ..sources import ingest
from . import context as ctx
from . import oracles as O
from .registry import query

# ------------------------------------------------------------------ S: sources

_SCAN_COLS = ["packet_id", "attack_type", "split", "gocb_ref", "time_s", "st_num", "sq_num", "ttl_ms",
              "length", "attack"]


@query("scan_packets", "S1", O.sql(
    "SELECT packet_id, attack_type, split, gocb_ref, " + O.r("time_s", "time_s") +
    ", st_num, sq_num, ttl_ms, length, CAST(attack AS BIGINT) AS attack FROM typed"))
def scan_packets(spark, sf):
    """Typed capture rows (the packets stand-in)."""
    return ctx.typed(spark, sf).select(*_SCAN_COLS)


_CAPTURED = ["attack_type", "split", "message_no", "gocb_ref", "time_s", "st_num", "sq_num", "ttl_ms", "length",
             "data_length", "boolean_1", "bitstring_bitcount", "attack"]


def _read_captures(spark, sf):
    """The stand-in written as capture CSVs (``Length`` twice in the header) in this run's folder, and read back."""
    import uuid

    from ..session import cut_lineage, prepare
    from ..sources.packets import packets
    root = f"{prepare(spark).sparkContext.getCheckpointDir()}/captures-{uuid.uuid4().hex}"
    rows = cut_lineage(packets(spark, sf).drop("_seg"))
    stream.release()
    files = ingest.write_captures(rows, root)
    return ingest.load_captures(spark, files)


@query("read_captures", "S1", O.sql(
    "SELECT packet_id + CAST(o AS BIGINT) AS packet_id, t.attack_type, t.split, packet_id AS message_no, gocb_ref, "
    + O.r("time_s", "time_s") + ", st_num, sq_num, ttl_ms, length, length AS data_length, boolean_1, bitstring_bitcount, "
    "CAST(attack AS BIGINT) AS attack FROM typed t JOIN files f ON f.attack_type = t.attack_type AND f.split = t.split",
    "files AS (SELECT attack_type, split, coalesce(SUM(MAX(packet_id) + 1) OVER (ORDER BY attack_type, split "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM typed GROUP BY attack_type, split)"))
def read_captures(spark, sf):
    """Capture files by header position: both ``Length`` fields, ids by (file, message number), typed."""
    rows = ingest.typed_packets(_read_captures(spark, sf)).withColumnRenamed(ingest.FILE_NO, "message_no")
    return rows.select("packet_id", *_CAPTURED)


@query("capture_lines", "S1", O.sql(
    "SELECT attack_type, split, COUNT(*) AS n, CAST(0 AS BIGINT) AS broken, CAST(0 AS BIGINT) AS unnumbered "
    "FROM typed GROUP BY attack_type, split"))
def capture_lines(spark, sf):
    """Per capture file: lines read, broken lines, lines without a message number."""
    return ingest.broken_lines(_read_captures(spark, sf))


@query("scan_project_mode", "S2", O.sql(
    "SELECT packet_id, attack_type, split, gocb_ref, ttl_ms, " + O.r("time_s", "time_s") +
    ", st_num, sq_num, length, boolean_raw, bit_string, CAST(attack AS BIGINT) AS attack, "
    "CAST(NULL AS DOUBLE) AS epoch_time, CAST(NULL AS DOUBLE) AS arrival_time, "
    "CAST(NULL AS DOUBLE) AS delta_captured, CAST(NULL AS DOUBLE) AS delta_displayed, "
    "CAST(NULL AS DOUBLE) AS time_since_first, CAST(NULL AS DOUBLE) AS time_shift, "
    "CAST(NULL AS BIGINT) AS frame_len, CAST(NULL AS BIGINT) AS frame_len_stored FROM typed"))
def scan_project_mode(spark, sf):
    """Full-mode allow-list projection (pruned at the scan)."""
    return ingest.project_mode(ctx.typed(spark, sf), "full").drop("t", "_seg")


@query("load_combined", "S3", O.sql(
    "SELECT attack_type, split, COUNT(*) AS n, " + O.b("SUM(attack)", "n_attack") + ", "
    + O.r("AVG(attack)", "attack_ratio") + " FROM typed GROUP BY attack_type, split"))
def load_combined(spark, sf):
    """Per file: rows, attacks and attack ratio of the combined load."""
    return (ctx.typed(spark, sf).groupBy("attack_type", "split")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("attack").alias("n_attack"),
                 F.avg("attack").alias("attack_ratio")))


@query("load_multiclass", "S4", O.sql(
    "SELECT packet_id, split, CASE WHEN attack = 0 THEN 'normal' ELSE lower(attack_type) END AS label FROM typed"))
def load_multiclass(spark, sf):
    """Five-class label per row."""
    return ingest.tag_multiclass(ctx.typed(spark, sf)).select("packet_id", "split", "label")


@query("load_advanced", "S5", O.sql(
    "SELECT packet_id, attack_type, split, source, destination FROM typed"))
def load_advanced(spark, sf):
    """Projection with the graph fields."""
    return ingest.project_mode(ctx.typed(spark, sf), "core", advanced=True).select(
        "packet_id", "attack_type", "split", "source", "destination")


_EXPECTED_VALUES = ", ".join(
    f"('{s}', '{c}', {n})" for s, d in ingest.EXPECTED_COUNTS.items() for c, n in d.items())


@query("validate_counts", "S8", O.sql(
    "SELECT coalesce(g.split, x.split) AS split, coalesce(g.label, x.label) AS label, "
    "CAST(coalesce(g.n, 0) AS BIGINT) AS n, CAST(x.expected AS BIGINT) AS expected, "
    "CAST(coalesce(g.n, 0) = coalesce(x.expected, -1) AS BIGINT) AS matches, "
    + O.r("100.0 * coalesce(g.n, 0) / SUM(coalesce(g.n, 0)) OVER (PARTITION BY coalesce(g.split, x.split))", "pct")
    + " FROM (SELECT split, CASE WHEN attack = 0 THEN 'normal' ELSE lower(attack_type) END AS label, "
    "COUNT(*) AS n FROM typed GROUP BY 1, 2) g FULL OUTER JOIN (VALUES " + _EXPECTED_VALUES +
    ") x(split, label, expected) ON g.split = x.split AND g.label = x.label"))
def validate_counts(spark, sf):
    """Label distribution per split against the published expected counts."""
    from ..operators.stats import validate_counts as vc
    return vc(ingest.tag_multiclass(ctx.typed(spark, sf)), ingest.EXPECTED_COUNTS)


# ------------------------------------------------------------------ C: typing


@query("parse_boolean", "C1", O.sql(
    "SELECT packet_id, boolean_1, boolean_2, boolean_3 FROM typed"))
def parse_boolean(spark, sf):
    """Comma-separated flags to three numbers."""
    return ctx.typed(spark, sf).select("packet_id", "boolean_1", "boolean_2", "boolean_3")


@query("map_boolean_single", "C2", O.sql(
    "SELECT packet_id, CAST(CASE WHEN lower(regexp_replace(boolean_raw, '^\\s+|\\s+$', '', 'g')) IN "
    "('true','1','yes','y','on') THEN 1.0 WHEN lower(regexp_replace(boolean_raw, '^\\s+|\\s+$', '', 'g')) IN "
    "('false','0','no','n','off') THEN 0.0 END AS DOUBLE) AS boolean_value FROM typed"))
def map_boolean_single(spark, sf):
    """Whole field mapped as one token."""
    return ctx.typed(spark, sf).select("packet_id", P.bool_token(F.col("boolean_raw")).alias("boolean_value"))


@query("bitstring_numeric", "C3", O.sql("SELECT packet_id, bitstring_numeric FROM typed"))
def bitstring_numeric(spark, sf):
    return ctx.typed(spark, sf).select("packet_id", "bitstring_numeric")


@query("bitstring_hex_int", "C4", O.sql(
    "SELECT packet_id, CAST(CASE WHEN length(z) <= 15 THEN CAST(('0x' || z) AS HUGEINT) WHEN length(z) <= 31 THEN "
    "CAST(CAST(('0x' || left(z, length(z) - 15)) AS UBIGINT) AS HUGEINT) * 1152921504606846976 + CAST(('0x' || right(z, 15)) AS HUGEINT) END AS VARCHAR) "
    "AS bitstring_int FROM (SELECT packet_id, regexp_replace(" + O._HEX + ", '^0+(.)', '\\1') AS z FROM typed)"))
def bitstring_hex_int(spark, sf):
    return ctx.typed(spark, sf).select("packet_id", F.col("bitstring_int").cast("string").alias("bitstring_int"))


@query("bitstring_popcount", "C5", O.sql("SELECT packet_id, bitstring_bitcount FROM typed"))
def bitstring_popcount(spark, sf):
    return ctx.typed(spark, sf).select("packet_id", "bitstring_bitcount")


@query("coerce_numeric", "C6", O.sql(
    "SELECT packet_id, TRY_CAST(bit_string AS DOUBLE) AS bit_string_num, "
    "TRY_CAST(substr(source, 2) AS DOUBLE) AS source_num, TRY_CAST(boolean_raw AS DOUBLE) AS boolean_num FROM typed"))
def coerce_numeric(spark, sf):
    """Text fields to numbers, bad text -> null."""
    t = ctx.typed(spark, sf)
    return t.select("packet_id", P.to_number("bit_string").alias("bit_string_num"),
                    P.to_number(F.expr("substring(source, 2)")).alias("source_num"),
                    P.to_number("boolean_raw").alias("boolean_num"))


@query("base_time", "C7", O.sql(
    "SELECT packet_id, " + O.r("base_time", "base_time") + ", "
    + O.r("epoch_us(TRY_CAST(t AS TIMESTAMP)) / 1000000.0", "t_epoch") + " FROM typed"))
def base_time(spark, sf):
    """Best available time and the parsed state-change time."""
    t = ctx.typed(spark, sf)
    return t.select("packet_id", "base_time", P.epoch_seconds("t").alias("t_epoch"))


@query("null_key", "C8", O.sql(
    "SELECT gocb_ref, COUNT(*) AS n FROM typed GROUP BY gocb_ref"))
def null_key(spark, sf):
    """Device key with nulls grouped under 'nan'."""
    return ctx.typed(spark, sf).groupBy("gocb_ref").agg(F.count(F.lit(1)).alias("n"))


@query("inf_to_null", "C9", O.sql(
    "SELECT packet_id, " + O.r("CASE WHEN isinf(r) OR isnan(r) THEN NULL ELSE r END", "ratio") + " FROM "
    "(SELECT packet_id, CASE WHEN value = 0 THEN CAST('inf' AS DOUBLE) ELSE 1.0 / value END AS r FROM typed)"))
def inf_to_null(spark, sf):
    """Non-finite values of a derived ratio become null."""
    t = ctx.typed(spark, sf)
    r = F.when(F.col("value") == 0, F.lit(float("inf"))).otherwise(F.lit(1.0) / F.col("value"))
    return t.select("packet_id", P.finite(r).alias("ratio"))


@query("label_attack_type", "C10", O.sql(
    "SELECT DISTINCT attack_type, lower(attack_type) AS lower_name, "
    "upper(substr(attack_type, 1, 1)) || lower(substr(attack_type, 2)) AS title_name, "
    "upper(attack_type) AS upper_name FROM typed"))
def label_attack_type(spark, sf):
    t = ctx.typed(spark, sf).select("attack_type").distinct()
    return t.select("attack_type", F.lower("attack_type").alias("lower_name"),
                    F.initcap("attack_type").alias("title_name"), F.upper("attack_type").alias("upper_name"))


# ------------------------------------------------------------------ F / G: features

FULL_QUERIES = {
    "inter_arrival": ("F1", ["inter_arrival"]),
    "jitter": ("F2", ["jitter_rolling_std"]),
    "rates": ("F3", ["msg_rate", "byte_rate"]),
    "ttl_check": ("F4", ["ttl_violation", "ttl_margin"]),
    "sq_transitions": ("F5", ["sqNum_delta", "sqNum_jump"]),
    "st_transitions": ("F6", ["stNum_delta", "stNum_change", "st_change"]),
    "sq_reset_on_st_change": ("F7", ["sq_reset_on_st_change"]),
    "length_delta": ("F8", ["length_delta"]),
    "event_rate_spike": ("F9", ["event_rate_spike"]),
    "bit_density": ("F10", ["bit_density"]),
    "t_change": ("F11", ["t_change"]),
    "status_bit_change": ("F12", ["status_bit_change"]),
    "sq_reset_rules": ("F13", ["sq_reset_expected", "sq_reset_violation"]),
    "t_st_consistency": ("F14", ["t_st_consistency_violation"]),
    "status_missing_on_event": ("F15", ["status_change_missing_on_event"]),
    "heartbeat": ("F16", ["ttl_half", "heartbeat_interval_error", "heartbeat_within_tol"]),
    "sq_inc_rules": ("F17", ["sq_inc_expected", "sq_inc_violation_when_no_event"]),
    "status_change_on_heartbeat": ("F18", ["status_change_violation_on_heartbeat"]),
    "st_hygiene": ("F19", ["stNum_jump_gt1", "sq_reset_without_st_change"]),
    "event_id": ("F20", ["event_id"]),
    "msgs_since_last_event": ("F21", ["msgs_since_last_event", "event_msg_rank"]),
    "time_since_last_event": ("F22", ["time_since_last_event"]),
    "config_change": ("F23", ["confRev_delta", "confRev_change", "cfg_change_goID", "cfg_change_datSet",
                              "cfg_change_confRev", "config_change_violation_on_event"]),
}

_INT_FEATURES = {"event_id", "msgs_since_last_event", "day", "hour", "second", "microsecond", "dayofweek",
                 "unix_time", "bool_true_count", "bool_false_count", "bool_has_true", "bool_all_false",
                 "bit_len", "bit_ones", "bit_zeros", "stNum_increased", "sqNum_reset"} | {f"bit_{i}" for i in range(8)}


def _sel(cols):
    return ", ".join(O.b(c, c) if c in _INT_FEATURES else O.r(c, c) for c in cols)


def _register_feature(name, ref, cols, frame, **kw):
    src = "features" if frame == "full" else "newf"

    @query(name, ref, O.sql(f"SELECT packet_id, {_sel(cols)} FROM {src}", **kw))
    def q(spark, sf, _cols=tuple(cols)):
        df = ctx.full(spark, sf) if frame == "full" else ctx.new(spark, sf)
        return df.select("packet_id", *_cols)


for _name, (_ref, _cols) in FULL_QUERIES.items():
    _register_feature(_name, _ref, _cols, "full", full=True)

NEW_QUERIES = {
    "time_parts": ("G1", ["day", "hour", "second", "microsecond", "dayofweek", "unix_time"]),
    "bool_stats": ("G2", ["bool_1", "bool_2", "bool_3", "bool_true_count", "bool_false_count", "bool_ratio",
                          "bool_has_true", "bool_all_false"]),
    "bit_text": ("G3", ["bit_len", "bit_ones", "bit_zeros"] + [f"bit_{i}" for i in range(8)]),
    "st_diff": ("G4", ["stNum_diff", "stNum_increased"]),
    "sq_diff": ("G5", ["sqNum_diff", "sqNum_reset", "delta_sqNum"]),
    "time_deviation": ("G6", ["time_between_msgs", "expected_interval", "time_deviation"]),
    "rolling10": ("G7", ["sqNum_roll_mean", "sqNum_roll_std", "Time_roll_mean", "Time_roll_std"]),
    "sq_st_ratio": ("G8", ["sq_st_ratio"]),
    "precise_time": ("G9", ["precise_time", "delta_time"]),
    "rolling5": ("G10", ["rolling_sqNum_mean"]),
}

for _name, (_ref, _cols) in NEW_QUERIES.items():
    _register_feature(_name, _ref, _cols, "new", new=True)


@query("drop_core", "G11", O.sql(
    "SELECT packet_id, attack_type, split, gocb_ref, " + _sel(["stNum_diff", "sqNum_diff", "delta_time"])
    + " FROM newf", new=True))
def drop_core(spark, sf):
    """New mode without the core inputs."""
    df = ctx.new(spark, sf).drop(*schema.NEW_MODE_DROPS)
    assert "st_num" not in df.columns
    return df.select("packet_id", "attack_type", "split", "gocb_ref", "stNum_diff", "sqNum_diff", "delta_time")


@query("full_features", "F1-F23", O.sql(
    "SELECT packet_id, " + _sel([c for c in schema.FULL_ENGINEERED]) + " FROM features", full=True))
def full_features(spark, sf):
    """Every full-mode engineered feature (flagship per-row table)."""
    return ctx.full(spark, sf).select("packet_id", *schema.FULL_ENGINEERED)


def engineer_on_typed(typed_df, target_rows=None):
    """Library entry: typed packets -> full features (no caching)."""
    return FE.engineer_full(typed_df, target_rows=target_rows)


_STREAM_COLS = ["inter_arrival", "msg_rate", "ttl_violation", "ttl_margin", "sqNum_delta", "sqNum_jump",
                "stNum_delta", "stNum_change", "sq_reset_on_st_change", "sq_reset_violation", "heartbeat_within_tol",
                "sq_inc_violation_when_no_event"]


@query("st_stream_rules", "stream", O.sql(
    "SELECT packet_id, attack_type, split, gocb_ref, " + _sel(_STREAM_COLS) + " FROM features", full=True))
def st_stream_rules(spark, sf):
    """Rule features computed online (Structured Streaming, per-device state) over time-ordered slices."""
    from ..streaming.rules import replay_as_stream
    return replay_as_stream(spark, ctx.typed(spark, sf)).select(
        "packet_id", "attack_type", "split", "gocb_ref", *_STREAM_COLS)


_SILENCE_SQL = O.sql(
    "SELECT attack_type, split, gocb_ref, " + O.r("min(base_time)", "alive_from") + ", "
    + O.r("max(valid_until)", "silent_from") + ", COUNT(*) AS n_messages FROM numbered "
    "GROUP BY attack_type, split, gocb_ref, period HAVING ceil(max(valid_until) * 1000) < "
    "(SELECT floor(max(base_time) * 1000) - 600000 FROM valid)",
    "valid AS (SELECT *, base_time + ttl_ms / 1000.0 AS valid_until FROM typed WHERE base_time IS NOT NULL "
    "AND ttl_ms IS NOT NULL)",
    "covered AS (SELECT *, max(valid_until) OVER (PARTITION BY attack_type, split, gocb_ref "
    "ORDER BY base_time, packet_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM valid)",
    "numbered AS (SELECT *, SUM(CASE WHEN base_time > before THEN 1 ELSE 0 END) OVER (PARTITION BY attack_type, "
    "split, gocb_ref ORDER BY base_time, packet_id ROWS UNBOUNDED PRECEDING) AS period FROM covered)")


@query("st_silences", "stream", _SILENCE_SQL)
def st_silences(spark, sf):
    """Periods after which a device fell silent, from event-time timers over the stream of typed packets."""
    from ..streaming.silence import run_once
    return run_once(spark, ctx.typed_stream(spark, sf))
