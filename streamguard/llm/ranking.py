"""Prefix sums and ranks over a global or grouped order without a single-task window.

The rows are range-partitioned by (group, order) and written to the shared
folder; each range's sums per group are a small table whose running totals
give every range its offset.  A group that holds a third of all rows spans
many ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common


def prefix_sums(df: DataFrame, order: list[str], value: str, out: str, group: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in ``order`` (within ``group``).

    Nulls sort first.  Rows equal in all of ``order`` come in an arbitrary but
    fixed order (the ranges are written once).
    """
    group = group or []
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") for c in group + order]
    ranged = common.cut(df.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()).sortWithinPartitions(*keys), "ranges")
    totals = ranged.groupBy(*group, "_range").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*[F.col(f"`{g}`") for g in group]).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range", *group).orderBy(*[F.col(f"`{c}`") for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    match = rows["_range"] == offsets["_range"]
    for g in group:
        match = match & rows[f"`{g}`"].eqNullSafe(offsets[f"`{g}`"])
    return rows.join(offsets, match).select(*[rows[f"`{c}`"] for c in df.columns], (F.col("_offset") + F.col("_inside")).alias(out))
