"""Missing-value profile and null checks, each in one pass over the data.

A per-column ``count()`` launches one job per column; a union of per-column filters scans once
per column. Here every column's counts are computed by one aggregate, and the row-level listing
is one scan that emits a row once per null column it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.functions.missing import is_blank, is_missing


def _pct(count_col, total_col):
    return F.try_divide(count_col.cast("double") * F.lit(100), total_col)


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long profile: column_name, data_type, total_rows, missing_count, missing_pct,
    blank_count, blank_pct. Missing = null (or NaN for float/double); blank also counts empty
    and all-space strings. An empty frame gives null percentages.
    """
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        aggs.append(F.count_if(is_missing(df, c)).alias(f"_m{i}"))
        aggs.append(F.count_if(is_blank(df, c)).alias(f"_b{i}"))
    wide = df.agg(*aggs)
    n = F.col("_n")
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            n.alias("total_rows"),
            F.col(f"_m{i}").alias("missing_count"),
            _pct(F.col(f"_m{i}"), n).alias("missing_pct"),
            F.col(f"_b{i}").alias("blank_count"),
            _pct(F.col(f"_b{i}"), n).alias("blank_pct"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*entries)))


def missing_profile_wide(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row, one column per input column: percent of rows missing (one aggregate)."""
    columns = list(columns or df.columns)
    n = F.count(F.lit(1))
    return df.agg(*[_pct(F.count_if(is_missing(df, c)), n).alias(c) for c in columns])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, null_rows for each checked column, from one aggregate."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(columns)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("null_rows"))
               for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*entries)))


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every row with a null in a checked column, once per such column, tagged ``null_column``.

    Same rows as ``null_rows_union`` but from a single scan (a generator instead of a union).
    """
    tags = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return (df.select("*", F.explode(tags).alias("null_column"))
              .where(F.col("null_column").isNotNull()))


def null_rows_union(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same listing as a UNION ALL of one filter per column (one scan per column)."""
    parts = [df.where(F.col(c).isNull()).withColumn("null_column", F.lit(c)) for c in columns]
    return reduce(DataFrame.unionAll, parts)


def has_nulls(df: DataFrame, columns: Sequence[str]) -> bool:
    """True if any checked column holds a null (stops at the first such row)."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return not df.where(cond).isEmpty()


def null_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows have a null in any checked column, and a verdict (one aggregate)."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    counts = df.agg(F.count(F.lit(1)).alias("checked_rows"),
                    F.count_if(any_null).alias("rows_with_nulls"))
    verdict = F.when(F.col("rows_with_nulls") == 0, F.lit("no nulls")) \
               .otherwise(F.lit("nulls found"))
    return counts.select(F.lit(", ".join(columns)).alias("checked_columns"), "*",
                         verdict.alias("verdict"))
