"""Numeric helpers shared by operators and result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = 1e-6  # fixed value: guard added to divisors
DIGITS = 6  # decimals kept in result tables that are compared across engines


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every float column (result tables compared across engines)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def dbl(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")
