"""Spark session helpers.

Cluster jobs take their settings (shuffle partitions, checkpoint folder,
broadcast threshold) from the session the caller built.  ``local_session``
exists for tests and the bench: it pins UTC, turns the UI off and sets a
checkpoint folder only when none is configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("streamguard")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("STREAMGUARD_DRIVER_MEMORY", "16g"))
    )
    if os.environ.get("STREAMGUARD_EVENT_LOG"):
        spark = (spark.config("spark.eventLog.enabled", "true")
                 .config("spark.eventLog.dir", os.environ["STREAMGUARD_EVENT_LOG"]))
    spark = spark.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job relies on; leaves cluster-provided values alone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # persisted stream frames keep their hash partitioning, so windows over them add no shuffle
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "false")
    # sketches of features x classes stay in hash tables: beyond 128 groups Spark would sort all values instead
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "1024")
    # the JVM never compiles a method of more bytecode: a stage too wide for one runs operator by operator instead
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if not spark.sparkContext.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="streamguard-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(configured)
    return spark


def side_by_side(spark: SparkSession, fns: Sequence[Callable[[], object]], at_once: int | None = None) -> list:
    """Independent fits in driver threads, at most ``at_once``: their small jobs share the executors, as in a cross-validator."""
    with ThreadPool(min(len(fns), at_once or len(fns))) as pool:
        return pool.map(lambda fn: inheritable_thread_target(spark)(fn)(), fns, chunksize=1)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder's path in the session's shared folder."""
    return f"{prepare(spark).sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, partitions: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder, by ``partitions``, and read it back."""
    spark = prepare(df.sparkSession)
    path = path or shared_path(spark, name)
    by = [c for c in partitions if c in df.columns]
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's checkpoint folder (survives executor loss).

    The frame is persisted first: a reliable checkpoint writes the data in a
    second job, which would otherwise recompute the whole lineage.
    """
    from pyspark import StorageLevel
    prepare(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = df.checkpoint(eager=True)
    df.unpersist()
    return out
