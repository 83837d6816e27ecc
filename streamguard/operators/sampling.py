"""Deterministic sampling and splitting.

Randomness comes from ``md5`` of the row id, so every engine draws the same
rows.  Per-group cuts rank rows with the skew-safe stream position instead of
a per-group window, so a group holding most rows is still split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stream

HOLDOUT_BUCKETS = 10     # fixed values: 1 in 10 rows held out ...
TRAIN_SHARE = 0.8        # ... and the first 80 % in row order for fitting


def id_hash(col: str = "packet_id"):
    return F.md5(F.col(col).cast("string"))


def hash_number(col: str = "packet_id"):
    """First 15 hex digits of the md5 as a number (monotone in the md5 text)."""
    return F.conv(F.substring(id_hash(col), 1, 15), 16, 10).cast("double")


def sample_fixed(df: DataFrame, n: int, id_col: str = "packet_id") -> DataFrame:
    """The ``n`` rows with the smallest id hash (a top-n: TakeOrderedAndProject)."""
    return df.orderBy(id_hash(id_col), F.col(id_col)).limit(n)


def rank_by_hash(df: DataFrame, keys, id_col: str = "packet_id", name: str = "_rank") -> DataFrame:
    """0-based rank of each row by id hash within ``keys`` (skew-safe)."""
    d = df.withColumn("_h", hash_number(id_col)).withColumn("_md5", id_hash(id_col))
    d = stream.segment_by_key(d, keys, "_h") if keys else stream.segmented(d, [], "_h")
    r = stream.position(d, list(keys), [F.col("_h"), F.col("_md5"), F.col(id_col)], name)
    return r.drop("_h", "_md5", stream.SEG, stream.LP, stream.CNT)


def balance_classes(df: DataFrame, label: str = "attack", group: str = "attack_type") -> DataFrame:
    """Keep every normal row; cut each attack type to the smallest type's count (by id hash)."""
    df = df.drop(stream.SEG, stream.LP, stream.CNT)
    attacks = df.filter(F.col(label) == 1)
    m = attacks.groupBy(group).count().agg(F.min("count")).collect()[0][0] or 0
    ranked = rank_by_hash(attacks, [group])
    kept = ranked.filter(F.col("_rank") < m).drop("_rank")
    return df.filter(F.col(label) == 0).unionByName(kept)


def holdout_split(df: DataFrame, order_col: str) -> DataFrame:
    """Id-hash 90/10 split and first-80 % split in ``order_col`` order."""
    n = df.count()
    cut = int(n * TRAIN_SHARE)
    d = stream.segmented(df, [], order_col)
    p = stream.position(d, [], [F.col(order_col)], "_row")
    bucket = F.conv(F.substring(id_hash("packet_id"), 1, 8), 16, 10).cast("bigint") % HOLDOUT_BUCKETS
    return p.select("packet_id",
                    F.when(bucket == 0, "holdout").otherwise("fit").alias("random_part"),
                    F.when(F.col("_row") < cut, "first80").otherwise("last20").alias("order_part"))
