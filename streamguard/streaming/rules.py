"""Protocol rules online: Structured Streaming with per-device state.

``stream_rules`` consumes a stream of typed messages, groups it by device and
keeps the device's last (time, stNum, sqNum) in ``applyInPandasWithState``.
Each micro-batch's rows of a device are ordered by (time, id) and compared
with the carried state, so the output equals the batch features F1, F4-F7,
F13 and F17 as long as each device's rows arrive in time order across
micro-batches (the source below delivers time slices in order).  State is one
small row per device.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.numeric import EPS
from ..operators.features import HB_TOL_ABS, HB_TOL_SHARE, RESET_SET
from ..session import prepare

KEYS = ["attack_type", "split", "gocb_ref"]
INPUT_COLS = ["packet_id", "attack_type", "split", "gocb_ref", "base_time", "st_num", "sq_num", "ttl_ms"]
OUT_SCHEMA = T.StructType([
    T.StructField("packet_id", T.LongType()), T.StructField("attack_type", T.StringType()),
    T.StructField("split", T.StringType()), T.StructField("gocb_ref", T.StringType()),
    T.StructField("inter_arrival", T.DoubleType()), T.StructField("msg_rate", T.DoubleType()),
    T.StructField("ttl_violation", T.DoubleType()), T.StructField("ttl_margin", T.DoubleType()),
    T.StructField("sqNum_delta", T.DoubleType()), T.StructField("sqNum_jump", T.DoubleType()),
    T.StructField("stNum_delta", T.DoubleType()), T.StructField("stNum_change", T.DoubleType()),
    T.StructField("sq_reset_on_st_change", T.DoubleType()), T.StructField("sq_reset_violation", T.DoubleType()),
    T.StructField("heartbeat_within_tol", T.DoubleType()),
    T.StructField("sq_inc_violation_when_no_event", T.DoubleType()),
])
STATE_SCHEMA = T.StructType([T.StructField("t", T.DoubleType()), T.StructField("st", T.DoubleType()),
                             T.StructField("sq", T.DoubleType())])


def _device_rules(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    pdf = pd.concat(list(batches), ignore_index=True)
    pdf = pdf.sort_values(["base_time", "packet_id"], na_position="last", kind="mergesort")
    t = pdf["base_time"].to_numpy(dtype=float)
    st = pdf["st_num"].to_numpy(dtype=float)
    sq = pdf["sq_num"].to_numpy(dtype=float)
    ttl = pdf["ttl_ms"].to_numpy(dtype=float)
    if state.exists:
        pt, pst, psq = state.get
        prev = lambda x, p: np.concatenate([[np.nan if p is None else p], x[:-1]])
        t0, st0, sq0 = prev(t, pt), prev(st, pst), prev(sq, psq)
    else:
        shift = lambda x: np.concatenate([[np.nan], x[:-1]])
        t0, st0, sq0 = shift(t), shift(st), shift(sq)
    ia = t - t0
    sqd, std = sq - sq0, st - st0
    with np.errstate(invalid="ignore"):
        change = ((std != 0) & ~np.isnan(std)).astype(float)
        reset = np.isin(sq, RESET_SET)
        hb = np.abs(ia - ttl / 2000.0) <= HB_TOL_SHARE * (ttl / 2000.0) + HB_TOL_ABS
        out = pd.DataFrame({
            "packet_id": pdf["packet_id"].astype("int64"), "attack_type": key[0], "split": key[1],
            "gocb_ref": key[2], "inter_arrival": ia, "msg_rate": 1.0 / (ia + EPS),
            "ttl_violation": (ia > ttl / 1000.0).astype(float), "ttl_margin": ttl / 1000.0 - ia,
            "sqNum_delta": sqd, "sqNum_jump": ((sqd != 1) & ~np.isnan(sqd)).astype(float),
            "stNum_delta": std, "stNum_change": change,
            "sq_reset_on_st_change": ((change == 1.0) & reset).astype(float),
            "sq_reset_violation": ((change == 1.0) & ~reset).astype(float),
            "heartbeat_within_tol": hb.astype(float),
            "sq_inc_violation_when_no_event": ((change == 0.0) & ~(sqd == 1)).astype(float),
        })
    last = len(pdf) - 1
    state.update((float(t[last]) if not np.isnan(t[last]) else None, float(st[last]), float(sq[last])))
    yield out


def stream_rules(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Streaming rule features per device (append mode)."""
    ev = events.select(*INPUT_COLS).withColumn("event_time", F.timestamp_seconds("base_time"))
    return (ev.withWatermark("event_time", watermark)
            .groupBy(*KEYS)
            .applyInPandasWithState(_device_rules, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout))


def replay_as_stream(spark: SparkSession, typed: DataFrame, slices: int = 4) -> DataFrame:
    """Run ``stream_rules`` over ``typed`` delivered as ``slices`` time-ordered micro-batches.

    The slices are written one after another into the session's checkpoint
    folder (the shared folder a cluster names); after each slice lands an
    incremental ``availableNow`` run reads only the new files, with the
    per-device state carried in the query checkpoint; results go to a Parquet
    sink there.
    """
    prepare(spark)
    root = os.path.join(spark.sparkContext.getCheckpointDir(), f"stream-rules-{uuid.uuid4().hex}")
    src, out, ckpt = (os.path.join(root, d) for d in ("source", "out", "checkpoint"))
    data = typed.select(*INPUT_COLS)
    lo, hi = data.agg(F.min("base_time"), F.max("base_time")).first()
    width = ((hi - lo) / slices) if hi is not None and hi > lo else 1.0
    part = F.least(F.floor((F.col("base_time") - F.lit(lo or 0.0)) / F.lit(width)), F.lit(slices - 1))
    sliced = data.withColumn("_slice", F.coalesce(part, F.lit(slices - 1)).cast("int"))
    schema = data.schema
    for i in range(slices):
        # a new time slice lands, the incremental query picks up only the new files;
        # per-device state carries over through the checkpoint
        sliced.filter(F.col("_slice") == i).drop("_slice").write.mode("overwrite").parquet(
            os.path.join(src, f"slice_{i:05d}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        q = (stream_rules(stream).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.schema(OUT_SCHEMA).parquet(out)
