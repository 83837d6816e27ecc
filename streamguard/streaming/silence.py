"""Devices that fall silent: event-time timers over a stream of messages.

Each message is valid for its time to live (``ttl_ms``).  A device is alive
while one of its messages is valid; when the watermark has passed the end of
such a period, no message can prolong it any more, and the period is given out.

Periods are unions of intervals, so their parts may arrive in any order and may
be merged anywhere: tasks merge the messages they read before the shuffle, and a
device's state takes the merged parts slice by slice.  A device that sends a
third of all messages is a handful of intervals behind the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import prepare, shared_path

KEYS = ["attack_type", "split", "gocb_ref"]
_KEY_SCHEMA = "attack_type string, split string, gocb_ref string"
_PART_SCHEMA = f"{_KEY_SCHEMA}, alive_from double, silent_from double, n_messages bigint, last_time timestamp"
OUT_SCHEMA = f"{_KEY_SCHEMA}, alive_from double, silent_from double, n_messages bigint"
_STATE_SCHEMA = "alive_from double, silent_from double, n_messages bigint"
WATERMARK = "10 minutes"
# Captures may count time from their start, and a stream's first watermark is the epoch, at which
# rows are late already: event times run this many seconds ahead of the messages' times.
AHEAD = 86_400


def merged(start: np.ndarray, end: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """The union of closed intervals as (starts, ends, summed n), ascending; touching ones are one."""
    order = np.argsort(start, kind="stable")
    start, end, n = start[order], end[order], n[order]
    reach = np.maximum.accumulate(end)
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return start[first], np.maximum.reduceat(end, first), np.add.reduceat(n, first)


def _merge_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Messages -> intervals per device, frame by frame."""
    for pdf in frames:
        for key, g in pdf.groupby(KEYS, sort=False, dropna=False):
            t = g["base_time"].to_numpy(dtype=float)
            start, end, n = merged(t, t + g["ttl_ms"].to_numpy(dtype=float) / 1000.0, np.ones(len(t), dtype=np.int64))
            last = np.sort(t)[np.cumsum(n) - 1]
            out = pd.DataFrame({"alive_from": start, "silent_from": end, "n_messages": n,
                                "last_time": pd.to_datetime(np.floor((last + AHEAD) * 1e6).astype("int64"), unit="us")})
            for i, (name, v) in enumerate(zip(KEYS, key)):
                out.insert(i, name, None if pd.isna(v) else v)
            yield out


class _Alive(StatefulProcessor):
    """Open periods of a device; one timer, at the end of the earliest."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _STATE_SCHEMA)

    def _load(self) -> tuple[np.ndarray, ...]:
        rows = list(self.open.get()) if self.open.exists() else []
        a = np.array([(r[0], r[1]) for r in rows], dtype=float).reshape(-1, 2)
        return a[:, 0], a[:, 1], np.array([r[2] for r in rows], dtype=np.int64)

    def _store(self, start: np.ndarray, end: np.ndarray, n: np.ndarray) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if len(start):
            self.open.put([(float(a), float(b), int(c)) for a, b, c in zip(start, end, n)])
            self.handle.registerTimer(_due(end).min().item())
        else:
            self.open.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, end, n = self._load()
        for pdf in rows:
            start, end, n = merged(np.concatenate([start, pdf["alive_from"].to_numpy(dtype=float)]),
                                   np.concatenate([end, pdf["silent_from"].to_numpy(dtype=float)]),
                                   np.concatenate([n, pdf["n_messages"].to_numpy(dtype=np.int64)]))
        self._store(start, end, n)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, end, n = self._load()
        over = _due(end) < timerValues.getCurrentWatermarkInMs()
        self._store(start[~over], end[~over], n[~over])
        if over.any():
            yield pd.DataFrame({**{k: [v] * int(over.sum()) for k, v in zip(KEYS, key)}, "alive_from": start[over],
                                "silent_from": end[over], "n_messages": n[over]})

    def close(self) -> None:
        pass


def _due(end: np.ndarray) -> np.ndarray:
    return np.ceil(end * 1000.0).astype(np.int64) + AHEAD * 1000


def silences(messages: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Stream of typed messages -> one row per period a device was alive, once it is over (append mode).

    alive_from: first message; silent_from: when its last message ceased to be valid; n_messages.
    Times are seconds from the epoch or from the capture's start, not below 0.  Messages without
    time or time to live are passed over.  Messages (merged with those they touch
    in the same slice) that lie before the watermark are late and dropped.  Periods the watermark
    has not passed stay in the state: a device's state holds those alone.
    """
    rows = messages.filter("base_time is not null and ttl_ms is not null").select(*KEYS, "base_time", "ttl_ms")
    return (rows.mapInPandas(_merge_rows, _PART_SCHEMA).withWatermark("last_time", watermark)
            .groupBy(*KEYS)
            .transformWithStateInPandas(_Alive(), OUT_SCHEMA, "Append", "EventTime"))


def run_once(spark: SparkSession, messages: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Read what the stream holds now, each file once, and return the periods that are over."""
    prepare(spark)
    root = shared_path(spark, "silences")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    # timers and list state need this store; a query keeps the setting it was started with
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = (silences(messages, watermark).writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(provider, before) if before else spark.conf.unset(provider)
    q.awaitTermination()
    return spark.read.schema(OUT_SCHEMA).parquet(f"{root}/out")
