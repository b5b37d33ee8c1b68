"""Business questions on the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def population_by_state_month(fact: DataFrame, year: int | None = None,
                              state: str | None = None) -> DataFrame:
    """Trips and average state population per (year, month, state).

    Optional filters on year and state; on a fact written partitioned by year and month the year
    filter prunes directories and the state filter is pushed into the Parquet scan.
    """
    rows = fact
    if year is not None:
        rows = rows.where(F.col("year") == F.lit(year))
    if state is not None:
        rows = rows.where(F.col("immigration_state_code") == F.lit(state))
    return rows.groupBy("year", "month", "immigration_state_code").agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg("avg_Total_Population").alias("avg_population"),
    )


def busiest_arrival_days(fact: DataFrame, k: int = 20) -> DataFrame:
    """Top-k arrival dates by trips; ties broken by the earlier date, so the k rows are fixed."""
    per_day = fact.groupBy("arrive_date").agg(F.count(F.lit(1)).alias("trips"))
    return per_day.orderBy(F.desc("trips"), F.asc("arrive_date")).limit(k)


def daily_summary(fact: DataFrame) -> DataFrame:
    """Per arrival day and state: trips and average population, with year and month to
    partition the written table by (the table behind a morning dashboard)."""
    return fact.groupBy("year", "month", "arrive_date", "immigration_state_code").agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg("avg_Total_Population").alias("avg_population"),
    )
