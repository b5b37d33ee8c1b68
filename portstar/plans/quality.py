"""Data-quality reports on the warehouse tables.

Every report is a DataFrame (the caller decides whether to show, write or assert on it) and
each scans its input once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.functions.missing import is_blank
from portstar.operators.dedup import duplicate_keys
from portstar.operators.setops import union_all
from portstar.plans.fact import state_side, demographics_by_state, trip_grain


def key_summary(df: DataFrame, table: str, key: str, approx: bool = False) -> DataFrame:
    """One row: table_name, key_column, total_rows, distinct_keys, non_null_keys."""
    distinct = F.approx_count_distinct(key) if approx else F.count_distinct(F.col(key))
    counts = df.agg(F.count(F.lit(1)).alias("total_rows"), distinct.alias("distinct_keys"),
                    F.count(F.col(key)).alias("non_null_keys"))
    return counts.select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "*")


def key_report(tables: dict[str, tuple[DataFrame, str]], approx: bool = False) -> DataFrame:
    """Key completeness and uniqueness per table, nulls and duplicates reported apart.

    ``tables`` maps a table name to (frame, key column). ``duplicate_rows`` counts rows beyond
    the first for each non-null key value; ``approx=True`` uses a sketch for the distinct count.
    """
    report = union_all([key_summary(df, name, key, approx) for name, (df, key) in tables.items()])
    nulls = F.col("total_rows") - F.col("non_null_keys")
    dups = F.col("non_null_keys") - F.col("distinct_keys")
    verdict = (F.when((nulls == 0) & (dups == 0), F.lit("ok"))
                .when(dups == 0, F.lit("null keys"))
                .when(nulls == 0, F.lit("duplicate keys"))
                .otherwise(F.lit("null and duplicate keys")))
    return report.select("*", nulls.alias("null_keys"), dups.alias("duplicate_rows"),
                         verdict.alias("verdict"))


def merge_report(trips: DataFrame, demographics: DataFrame, by_state: DataFrame | None = None) -> DataFrame:
    """How the fact's join condition treats the trips, in one pass (a broadcast outer join).

    trip_rows (fact grain), trips_with_state, fact_rows (trips that found demographics),
    null_state_trips, unmatched_state_trips (state given but unknown) and a verdict.
    """
    side = state_side(by_state if by_state is not None else demographics_by_state(demographics))
    grain = trip_grain(trips)
    joined = grain.join(side.select("demographics_state_code"),
                        F.col("state_code") == F.col("demographics_state_code"), "left")
    counts = joined.agg(
        F.count(F.lit(1)).alias("trip_rows"),
        F.count("state_code").alias("trips_with_state"),
        F.count("demographics_state_code").alias("fact_rows"),
        F.count_if(F.col("state_code").isNull()).alias("null_state_trips"),
        F.count_if(F.col("state_code").isNotNull() & F.col("demographics_state_code").isNull())
         .alias("unmatched_state_trips"),
    )
    verdict = F.when(F.col("trip_rows") == F.col("fact_rows"), F.lit("ok")) \
               .otherwise(F.lit("trips dropped by the join"))
    return counts.select("*", verdict.alias("verdict"))


def duplicate_listing(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once with their count, most frequent first."""
    return duplicate_keys(df, keys).orderBy(F.desc("count"), *[F.asc(k) for k in keys])


def missing_value_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is missing or blank (type-aware: no '' comparison on dates)."""
    return df.where(is_blank(df, column))
