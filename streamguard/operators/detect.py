"""Unsupervised detectors (B1-B11): thresholds, clustering rules, isolation forest, DBSCAN, reconstruction error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stream


def top_share(df: DataFrame, score: str, share: float, id_col: str = "packet_id") -> DataFrame:
    """Flag the ``share`` of rows with the largest score: rank > floor(n (1 - share)) in (score, id) order.

    The rank is a skew-safe stream position over score segments, not a global sort.
    """
    n = df.count()
    cut = int(n * (1.0 - share))
    d = stream.segmented(df.drop(stream.SEG, stream.LP, stream.CNT), [], score)
    p = stream.position(d, [], [F.col(score), F.col(id_col)], "_rank0")
    return p.withColumn("flagged", ((F.col("_rank0") + 1) > cut).cast("int")).drop("_rank0")
