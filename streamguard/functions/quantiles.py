"""Exact quantiles per group without pulling a group into one task.

``percentile`` keeps every value of a group in memory; ``percentile_approx``
is bounded but inexact.  ``exact_quantiles`` uses the approximate sketch only
to bracket the wanted ranks (rank error <= n / accuracy), counts the rows below
each bracket and, with a map-side combine, the rows per value in it, and ranks
just those distinct values: a value that most rows share is one row there, and
only the bracket's values are shuffled.  Groups are few (features x classes).  Interpolation is linear between order statistics (numpy / pandas /
DuckDB ``quantile_cont``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the sketch: its size per group and task, not that of the result


def exact_quantiles(df: DataFrame, value: str | Column, groups: Sequence[str], probs: Sequence[float],
                    prefix: str = "q", accuracy: int = ACCURACY) -> DataFrame:
    """One row per group: ``groups`` + ``{prefix}{i}`` for each prob (null for empty groups)."""
    groups = list(groups)
    whole = not groups
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    if whole:
        df, groups = df.withColumn("_all", F.lit(0)), ["_all"]
    d = df.select(*groups, v.alias("_v")).filter(F.col("_v").isNotNull())
    delta = 10.0 / accuracy
    lo_p = [max(0.0, p - delta) for p in probs]
    hi_p = [min(1.0, p + delta) for p in probs]
    stats = d.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", lo_p + hi_p, accuracy).alias("_q"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    rows = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        # Small groups (below 2 / delta rows) are ranked whole: the sketch's
        # discrete rank offset is only covered by the margin beyond that size.
        small = F.col("_n") * F.lit(delta) < 2
        lo = F.when(small, F.col("_min")).otherwise(F.col("_q")[i])
        hi = F.when(small, F.col("_max")).otherwise(F.col("_q")[len(probs) + i])
        rows.append(F.struct(F.lit(i).alias("i"), lo.alias("lo"), hi.alias("hi"),
                             F.floor(h).cast("bigint").alias("k"), (h - F.floor(h)).alias("frac")))
    brackets = stats.select(*groups, "_n", F.explode(F.array(*rows)).alias("b")).select(
        *groups, "_n", "b.*")
    # Values below the bracket are one row, those in it a row per value, those above drop out.
    held = d.join(F.broadcast(brackets), on=groups, how="inner").filter(F.col("_v") <= F.col("hi"))
    under = F.col("_v") < F.col("lo")
    counted = held.groupBy(*groups, "i", F.when(~under, F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"), F.first("lo").alias("lo"), F.first("k").alias("k"), F.first("frac").alias("frac"))
    w = Window.partitionBy(*groups, "i").orderBy(F.col("_v").asc_nulls_first())
    # the row of the values below comes first; a value holds the ranks from _r - _c to _r - 1
    ranked = counted.withColumn("_r", F.sum("_c").over(w)).filter(F.col("_v").isNotNull())
    holds = lambda k: (F.col("_r") - F.col("_c") <= k) & (k < F.col("_r"))
    ranked = ranked.filter(holds(F.col("k")) | holds(F.col("k") + 1))
    picked = ranked.groupBy(*groups, "i").agg(
        F.max(F.when(holds(F.col("k")), F.col("_v"))).alias("_a"),
        F.max(F.when(holds(F.col("k") + 1), F.col("_v"))).alias("_b"),
        F.first("frac").alias("frac"))
    q = F.when(F.col("_b").isNull() | (F.col("frac") == 0), F.col("_a")).otherwise(
        F.col("_a") + F.col("frac") * (F.col("_b") - F.col("_a")))
    out = picked.select(*groups, "i", q.alias("_q"))
    out = out.groupBy(*groups).pivot("i", list(range(len(probs)))).agg(F.first("_q"))
    out = out.select(*groups, *[F.col(str(i)).alias(f"{prefix}{i}") for i in range(len(probs))])
    return out.drop("_all") if whole else out
