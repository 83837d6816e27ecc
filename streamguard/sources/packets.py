"""The ``packets`` table: capture-shaped message streams derived from ``events``.

One device per ``user_id``; the state counter steps at every signup or
purchase, the sequence counter counts messages since the last step, ``t`` is
the time of the last step.  The derivation is fixed (the same text is given to
DuckDB as the oracle prefix, see ``plans.oracles``).  The per-user running
count uses the segmented stream machinery, so one very busy user does not land
in a single task.  The output keeps ``_seg``: downstream stream features
partition by the same (attack_type, split, gocb_ref, _seg) and reuse the
exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import stream

DEVICE_KEYS = ["attack_type", "split", "gocb_ref"]

# Fixed values of the stand-in derivation.
ATTACK_TYPES = ["replay", "masquerade", "injection", "poisoning"]  # by user_id % 4
STATE_EVENTS = ["signup", "purchase"]  # event types that step the state counter
ATTACK_EVENT = "error"  # event type labelled as an attack


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packets(spark: SparkSession, sf_dir: str,
            target_rows: int | None = stream.DEFAULT_TARGET_ROWS) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value", "props")
    uid = F.col("user_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = e.select(
        "event_id", "user_id", "ts", "event_type", "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        (us / F.lit(1000000.0)).alias("time_s"),
        F.when(uid % 4 == 0, "replay").when(uid % 4 == 1, "masquerade")
         .when(uid % 4 == 2, "injection").otherwise("poisoning").alias("attack_type"),
        F.when(uid % 8 < 4, "train").otherwise("test").alias("split"),
        # never null; coalesce marks the key non-nullable so typing keeps it as is
        F.coalesce(F.concat(F.lit("IED"), uid.cast("string")), F.lit("nan")).alias("gocb_ref"),
    )
    e = stream.segmented(e, DEVICE_KEYS, "time_s", target_rows)
    order = [F.col("ts").asc_nulls_last(), F.col("event_id").asc()]
    e = stream.runs(e, DEVICE_KEYS, order, F.col("event_type").isin(*STATE_EVENTS), F.col("ts"), "ev")
    k = F.col("k")
    eid = F.col("event_id")
    return e.select(
        eid.alias("packet_id"),
        "attack_type", "split", "gocb_ref", "time_s",
        F.col("ev_start").alias("t"),
        (1 + F.col("ev_id") + F.when(eid % 97 == 0, 900).otherwise(0)).cast("bigint").alias("st_num"),
        (F.col("ev_pos") + F.when(eid % 37 == 0, 5).otherwise(0)).cast("bigint").alias("sq_num"),
        F.when(F.col("event_type") == ATTACK_EVENT, F.lit(10))
         .otherwise(F.lit(40000000) * (1 + k % 2)).cast("bigint").alias("ttl_ms"),
        (F.lit(130) + k % 40).cast("bigint").alias("length"),
        F.when(k % 10 == 0, "True").when(k % 10 == 1, "False,True")
         .when(k % 10 < 5, "false, TRUE,False,1").otherwise("True,no,off").alias("boolean_raw"),
        F.when(eid % 5 == 0, F.lit(None).cast("string")).when(k % 4 == 0, "40").otherwise("80").alias("bit_string"),
        F.concat(F.lit("h"), (F.col("user_id") % 50).cast("string")).alias("source"),
        F.concat(F.lit("h"), (k % 20).cast("string")).alias("destination"),
        "value",
        F.when(F.col("event_type") == ATTACK_EVENT, 1).otherwise(0).cast("int").alias("attack"),
        stream.SEG,
    )
