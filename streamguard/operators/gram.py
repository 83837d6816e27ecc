"""Pairwise-complete correlations from masked Gram matrices.

With Z the centred and scaled values (0 where missing) and M the presence mask, the
products M'M, Z'M, (Z*Z)'M and Z'Z hold, for every pair of features, the number
of complete rows and the sums a correlation needs.  Each task adds them up over
its Arrow batches and hands out one row per (group, pair); Spark sums those.  No
data row is repeated or shuffled, and what is shuffled (tasks x pairs) does not
follow the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SUMS = ["n", "sa", "sb", "qa", "qb", "ab"]
_BOUNDS = ["a_min", "a_max", "b_min", "b_max"]


class _Gram:
    """Sums of one group in one task; ``[i, j]`` is feature i over the rows where i and j are present."""

    def __init__(self, d: int):
        self.n, self.s, self.q, self.ab = (np.zeros((d, d)) for _ in range(4))
        self.lo, self.hi = np.full((d, d), np.inf), np.full((d, d), -np.inf)

    def add(self, x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> None:
        present = np.isfinite(x)
        m = present.astype(float)
        z = np.where(present, (np.where(present, x, 0.0) - centre) / scale, 0.0)
        self.n += m.T @ m
        self.s += z.T @ m
        self.q += (z * z).T @ m
        self.ab += z.T @ z
        # extremes tell constant sides exactly; features missing in the same rows share a pass
        masks: dict[bytes, list[int]] = {}
        for j in range(x.shape[1]):
            masks.setdefault(present[:, j].tobytes(), []).append(j)
        for cols in masks.values():
            both = present & present[:, cols[:1]]
            lo = np.where(both, x, np.inf).min(axis=0, initial=np.inf)
            hi = np.where(both, x, -np.inf).max(axis=0, initial=-np.inf)
            self.lo[:, cols] = np.minimum(self.lo[:, cols], lo[:, None])
            self.hi[:, cols] = np.maximum(self.hi[:, cols], hi[:, None])

    def rows(self) -> dict[str, np.ndarray]:
        i, j = np.triu_indices(len(self.n), 1)
        return {"i": i.astype(np.int32), "j": j.astype(np.int32), "n": self.n[i, j], "sa": self.s[i, j],
                "sb": self.s[j, i], "qa": self.q[i, j], "qb": self.q[j, i], "ab": self.ab[i, j],
                "a_min": self.lo[i, j], "a_max": self.hi[i, j], "b_min": self.lo[j, i], "b_max": self.hi[j, i]}


def finite(c: str) -> Column:
    """A column as double, null where it is missing, NaN or infinite."""
    x = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def correlations(df: DataFrame, features: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every feature pair over its complete rows, per group of ``ids``.

    Returns (ids..., fa, fb, n, corr), pairs in the order of ``features``; ``corr`` is null
    when fewer than two rows are complete or a side is constant on them.  NaN and infinite
    values are missing.  A group of null ids is a group; groups without rows give no rows.
    ``ids`` must be columns of few values (labels, attack types): a task keeps one set of
    matrices per group.
    """
    features, ids = list(features), list(ids)
    d = len(features)
    x = df.select(*ids, *[finite(c).alias(f"_x{k}") for k, c in enumerate(features)])
    shape = x.agg(*[e.alias(f"{n}{k}") for k in range(d) for n, e in (
        ("m", F.avg(f"_x{k}")), ("s", F.max(f"_x{k}") / 2 - F.min(f"_x{k}") / 2))]).first()
    # by half the range, as squares of very large values would overflow in a deviation
    centre = np.array([shape[f"m{k}"] or 0.0 for k in range(d)])
    scale = np.array([shape[f"s{k}"] or 1.0 for k in range(d)])
    id_fields = [f for f in x.schema.fields if f.name in ids]
    schema = T.StructType(id_fields + [T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType())]
                          + [T.StructField(c, T.DoubleType()) for c in _SUMS + _BOUNDS])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[tuple, _Gram] = {}
        id_types = None
        for batch in batches:
            if not batch.num_rows:
                continue
            id_types = [batch.schema.field(c).type for c in ids]
            values = np.column_stack([batch.column(len(ids) + k).cast(pa.float64()).to_numpy(zero_copy_only=False)
                                      for k in range(d)]).astype(float)
            for key, rows in _groups(batch, len(ids)):
                grams.setdefault(key, _Gram(d)).add(values[rows], centre, scale)
        for key, g in grams.items():
            r = g.rows()
            n = len(r["i"])
            cols = [pa.array([k] * n, type=t) for k, t in zip(key, id_types)]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(v) for v in r.values()], names=ids + list(r))

    sums = (x.mapInArrow(partial, schema).groupBy(*ids, "i", "j")
            .agg(*[F.sum(c).alias(c) for c in _SUMS],
                 *[(F.min if c.endswith("min") else F.max)(c).alias(c) for c in _BOUNDS]))
    n = F.col("n")
    cov = F.col("ab") - F.try_divide(F.col("sa") * F.col("sb"), n)
    va = F.col("qa") - F.try_divide(F.col("sa") * F.col("sa"), n)
    vb = F.col("qb") - F.try_divide(F.col("sb") * F.col("sb"), n)
    varies = (F.col("a_max") > F.col("a_min")) & (F.col("b_max") > F.col("b_min"))
    corr = F.when(varies & (va > 0) & (vb > 0), F.try_divide(cov, F.sqrt(va) * F.sqrt(vb)))
    names = F.array(*[F.lit(f) for f in features])
    return sums.select(*ids, F.get(names, F.col("i")).alias("fa"), F.get(names, F.col("j")).alias("fb"),
                       n.cast("bigint").alias("n"), corr.alias("corr"))


def _groups(batch: pa.RecordBatch, n_ids: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """(key, row numbers) of a batch's groups."""
    if not n_ids:
        yield (), np.arange(batch.num_rows)
        return
    codes = np.zeros(batch.num_rows, dtype=np.int64)
    for k in range(n_ids):
        enc = batch.column(k).dictionary_encode(null_encoding="encode")
        codes = codes * (len(enc.dictionary) + 1) + enc.indices.to_numpy(zero_copy_only=False)
    first = np.unique(codes, return_index=True)[1]
    for f in first:
        yield tuple(batch.column(k)[f].as_py() for k in range(n_ids)), np.flatnonzero(codes == codes[f])
