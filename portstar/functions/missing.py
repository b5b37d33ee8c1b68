"""Type-aware missing-value predicates.

``isnan`` only exists for floating types (on strings it raises, on timestamps it is a type error)
and comparing a date with ``''`` is an invalid cast under ANSI mode, so every predicate looks at
the column's type first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_missing(df: DataFrame, name: str) -> Column:
    """Null for every type, plus NaN for float/double."""
    c = F.col(name)
    if isinstance(_dtype(df, name), FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_blank(df: DataFrame, name: str) -> Column:
    """Missing, or for strings empty / only spaces."""
    c = F.col(name)
    if isinstance(_dtype(df, name), T.StringType):
        return c.isNull() | (F.trim(c) == F.lit(""))
    return is_missing(df, name)
