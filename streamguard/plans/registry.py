"""Registry of named queries: a Spark builder and, where SQL can say it, DuckDB text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import DIGITS

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    oracle: str | None
    ref: str  # SURVEY id


QUERIES: dict[str, Query] = {}


def rounded(c, digits: int = DIGITS):
    """Result-table rounding: ``digits`` decimals, at most SIG significant digits.

    Sums taken in a different order differ in the last bits; rounding with the
    same float operations on both engines makes equal results compare equal.
    """
    # result tables never carry NaN: it becomes SQL NULL, as everywhere in the library
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(sig_round(F.round(c, digits)))


SIG = 10


def sig_round(c):
    """Round to SIG significant digits with plain float operations (same formula in the oracle text)."""
    k = F.lit(SIG - 1) - F.floor(F.log10(F.abs(c)))
    up = F.floor(c * F.pow(F.lit(10.0), k) + 0.5) / F.pow(F.lit(10.0), k)
    down = F.floor(c / F.pow(F.lit(10.0), -k) + 0.5) * F.pow(F.lit(10.0), -k)
    return F.when(c.isNull() | (c == 0) | F.isnan(c), c).when(k >= 0, up).otherwise(down)


def normalize(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Result-table types: integers -> bigint, floats -> double rounded, booleans -> bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = rounded(c.cast("double"), digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, ref: str, oracle: str | None = None, raw: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: Builder) -> Builder:
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return out if raw else normalize(out)
        build.__name__ = name
        build.__doc__ = fn.__doc__
        QUERIES[name] = Query(name, build, oracle, ref)
        return fn
    return deco
