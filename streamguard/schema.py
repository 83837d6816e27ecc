"""Column names, types and feature lists.

Raw capture fields get snake_case engine names; engineered features keep the
names users know from the result tables (``inter_arrival``, ``stNum_delta`` ...).
"""

from __future__ import annotations

from pyspark.sql import types as T

DEVICE = ["attack_type", "split", "gocb_ref"]   # one device stream per file
FILE = ["attack_type", "split"]                 # one capture file

# Capture header -> engine column.
CAPTURE_COLUMNS = {
    "No.": "packet_id",
    "gocbRef": "gocb_ref",
    "Time": "time_s",
    "Epoch Time": "epoch_time",
    "Arrival Time": "arrival_time",
    "t": "t",
    "stNum": "st_num",
    "sqNum": "sq_num",
    "timeAllowedtoLive": "ttl_ms",
    "Length": "length",
    "Length.1": "data_length",      # the header's second Length
    "Frame length on the wire": "frame_len",
    "Frame length stored into the capture file": "frame_len_stored",
    "boolean": "boolean_raw",
    "bit-string": "bit_string",
    "Time delta from previous captured frame": "delta_captured",
    "Time delta from previous displayed frame": "delta_displayed",
    "Time since reference or first frame": "time_since_first",
    "Time shift for this packet": "time_shift",
    "Source": "source",
    "Destination": "destination",
    "confRev": "conf_rev",
    "numDatSetEntries": "n_entries",
    "goID": "go_id",
    "datSet": "dat_set",
    "attack": "attack",
}

# Typed raw columns after ingest (missing ones are added as typed nulls).
RAW_TYPES: dict[str, T.DataType] = {
    "packet_id": T.LongType(),
    "attack_type": T.StringType(),
    "split": T.StringType(),
    "gocb_ref": T.StringType(),
    "time_s": T.DoubleType(),
    "epoch_time": T.DoubleType(),
    "arrival_time": T.DoubleType(),
    "t": T.StringType(),
    "st_num": T.LongType(),
    "sq_num": T.LongType(),
    "ttl_ms": T.LongType(),
    "length": T.LongType(),
    "frame_len": T.LongType(),
    "frame_len_stored": T.LongType(),
    "boolean_raw": T.StringType(),
    "bit_string": T.StringType(),
    "delta_captured": T.DoubleType(),
    "delta_displayed": T.DoubleType(),
    "time_since_first": T.DoubleType(),
    "time_shift": T.DoubleType(),
    "source": T.StringType(),
    "destination": T.StringType(),
    "conf_rev": T.LongType(),
    "n_entries": T.LongType(),
    "go_id": T.StringType(),
    "dat_set": T.StringType(),
    "attack": T.IntegerType(),
    "value": T.DoubleType(),  # payload value carried by the packets stand-in
}

# Typed likewise, but only where the input has them.
OPTIONAL_TYPES: dict[str, T.DataType] = {"data_length": T.LongType()}

# Projection per mode (S2), engine names; `advanced` adds the graph fields.
CORE_FIELDS = ["gocb_ref", "ttl_ms", "time_s", "t", "st_num", "sq_num", "length",
               "boolean_raw", "bit_string", "attack"]
ALLOWED_FIELDS = CORE_FIELDS + ["epoch_time", "arrival_time", "delta_captured", "delta_displayed",
                                "time_since_first", "time_shift", "frame_len", "frame_len_stored"]
ADVANCED_FIELDS = ["source", "destination"]
CONFIG_FIELDS = ["conf_rev", "n_entries", "go_id", "dat_set"]

# Numeric feature lists per mode (M1).
CORE_NUMERIC = ["ttl_ms", "st_num", "sq_num", "length", "boolean_1", "boolean_2", "boolean_3",
                "bitstring_numeric", "bitstring_bitcount"]
FULL_RAW_NUMERIC = ["epoch_time", "arrival_time", "length", "frame_len", "frame_len_stored", "ttl_ms",
                    "st_num", "sq_num", "delta_captured", "delta_displayed", "time_since_first",
                    "time_shift", "boolean_1", "boolean_2", "boolean_3", "bitstring_numeric",
                    "bitstring_bitcount"]
FULL_ENGINEERED = [
    "base_time", "inter_arrival", "jitter_rolling_std", "msg_rate", "byte_rate",
    "ttl_violation", "ttl_margin", "sqNum_delta", "sqNum_jump", "stNum_delta", "stNum_change",
    "sq_reset_on_st_change", "length_delta", "event_rate_spike", "bit_density",
    "st_change", "t_change", "status_bit_change", "sq_reset_expected", "sq_reset_violation",
    "t_st_consistency_violation", "status_change_missing_on_event",
    "ttl_half", "heartbeat_interval_error", "heartbeat_within_tol",
    "sq_inc_expected", "sq_inc_violation_when_no_event", "status_change_violation_on_heartbeat",
    "stNum_jump_gt1", "sq_reset_without_st_change",
    "event_id", "msgs_since_last_event", "time_since_last_event", "event_msg_rank",
]
NEW_FEATURES = [
    "day", "hour", "second", "microsecond", "dayofweek", "unix_time",
    "bool_1", "bool_2", "bool_3",
    "bool_true_count", "bool_false_count", "bool_ratio", "bool_has_true", "bool_all_false",
    "bit_len", "bit_ones", "bit_zeros", "bit_0", "bit_1", "bit_2", "bit_3", "bit_4", "bit_5", "bit_6", "bit_7",
    "stNum_diff", "sqNum_diff", "time_between_msgs", "expected_interval", "time_deviation",
    "stNum_increased", "sqNum_reset",
    "sqNum_roll_mean", "sqNum_roll_std", "Time_roll_mean", "Time_roll_std",
    "sq_st_ratio",
    "precise_time", "delta_time", "delta_sqNum", "rolling_sqNum_mean",
]
# Inputs removed in `new` mode.
NEW_MODE_DROPS = ["ttl_ms", "st_num", "sq_num", "length", "boolean_1", "boolean_2", "boolean_3",
                  "bitstring_numeric", "bitstring_bitcount", "time_s", "t"]

UCAD_FEATURES = [
    "inter_arrival", "jitter_rolling_std", "msg_rate", "byte_rate",
    "ttl_violation", "ttl_margin", "sqNum_jump", "stNum_change",
    "length_delta", "length", "frame_len",
    "sq_reset_violation", "t_st_consistency_violation",
    "status_change_missing_on_event", "heartbeat_interval_error",
    "sq_inc_violation_when_no_event", "status_change_violation_on_heartbeat",
    "stNum_jump_gt1", "sq_reset_without_st_change",
    "event_msg_rank",
]

# Five-class label order (index 0..4).
CLASSES = ["normal", "injection", "masquerade", "poisoning", "replay"]
ATTACK_TYPES = ["replay", "masquerade", "injection", "poisoning"]


def mode_features(mode: str) -> list[str]:
    if mode == "core":
        cols = CORE_NUMERIC
    elif mode == "full":
        cols = FULL_RAW_NUMERIC + FULL_ENGINEERED
    elif mode == "new":
        cols = NEW_FEATURES
    elif mode == "core_new":
        cols = CORE_NUMERIC + NEW_FEATURES
    else:
        raise ValueError(f"unknown mode {mode!r}")
    seen: list[str] = []
    for c in cols:
        if c != "attack" and c not in seen:
            seen.append(c)
    return seen
