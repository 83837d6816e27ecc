"""Shared inputs of the registered queries.

The packets stand-in and the two feature frames are read by most queries.
Each is computed once per (session, data folder) and written as a Parquet table,
partitioned by attack type and split, into the session's shared folder; queries
read only the partitions and columns they use.  Streams are sorted by those two
first, so the writer, which wants the rows by partition, need not sort them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators import features as FE
from ..operators import stream
from ..session import prepare, shared_path, write_table
from ..sources import ingest
from ..sources.packets import packets, read_table

_CACHE: dict[tuple, DataFrame] = {}
_PATHS: dict[tuple, str] = {}

# Fixed value of the stand-in: configuration revision steps on every 211th packet.
CONF_REV_STEP = 211


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, name)


def _cached(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    k = _key(spark, sf_dir, name)
    if k not in _CACHE:
        prepare(spark)
        _PATHS[k] = shared_path(spark, name)
        _CACHE[k] = write_table(build(), name, schema.FILE, _PATHS[k])
        stream.release()
    return _CACHE[k]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed packets (C1-C9) with the stand-in's configuration revision (F23 input)."""
    def build():
        p = packets(spark, sf_dir).withColumn(
            "conf_rev", (1 + (F.col("packet_id") % CONF_REV_STEP == 0).cast("int")).cast("bigint"))
        return ingest.typed_packets(p)
    return _cached(spark, sf_dir, "typed", build)


def typed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of typed packets as a file stream."""
    schema = typed(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(_PATHS[_key(spark, sf_dir, "typed")])


def full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-mode features F1-F23 (stream columns dropped)."""
    return _cached(spark, sf_dir, "full",
                   lambda: FE.engineer_full(typed(spark, sf_dir)).drop(stream.LP, stream.CNT))


def new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New-mode features G1-G10 (inputs kept)."""
    return _cached(spark, sf_dir, "new",
                   lambda: FE.engineer_new(typed(spark, sf_dir)).drop(stream.LP, stream.CNT))


def clear() -> None:
    _CACHE.clear()
    _PATHS.clear()
