"""A Bloom filter of fixed size that keeps rows without a partner out of a join's shuffle.

The filter's bytes are bounded by ``BITS`` whatever the tables' sizes, so it
may be broadcast; the join that follows stays exact.  When the key set
outgrows the filter it lets more rows through, up to all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .wordhash import U, mix

BITS = 1 << 24
HASHES = 3


def _places(ids: np.ndarray) -> list[np.ndarray]:
    return [(mix(ids.astype(np.int64).view(U) + U(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))) >> U(40)).astype(np.int64) for k in range(HASHES)]


@contextmanager
def might_contain(df: DataFrame, key: str, keys: DataFrame) -> Iterator[DataFrame]:
    """Rows of ``df`` whose long ``key`` may be among ``keys`` (a one-column table).

    The rows must be written or counted inside the ``with`` block; the filter goes at its end.
    """
    spark = df.sparkSession
    name = keys.columns[0]

    def fill(batches):
        bits = np.zeros(BITS, bool)
        for b in batches:
            for p in _places(b.column(name).to_numpy(zero_copy_only=False)):
                bits[p] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["at", "word"])
    rows = keys.where(F.col(name).isNotNull()).coalesce(16).mapInArrow(common.tidy(fill), "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    words = np.zeros(BITS // 64, np.int64)  # 2 MB at most
    table = rows.toArrow()
    words[table.column("at").to_numpy()] = table.column("word").to_numpy()
    shared = spark.sparkContext.broadcast(words.tobytes())

    def keep(batches):
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").view(bool)
        for b in batches:
            ids = b.column(key).fill_null(0).to_numpy(zero_copy_only=False)
            ok = np.logical_and.reduce([bits[p] for p in _places(ids)])
            yield b.filter(pa.array(ok))
    try:
        yield df.mapInArrow(common.tidy(keep), df.schema)
    finally:
        shared.destroy()
