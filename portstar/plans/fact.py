"""The fact table: distinct trips joined to per-state demographic averages.

Each trip's state has one row of averages, so averaging again after the join (as a GROUP BY over
every trip column would) is the identity and the outer GROUP BY is a DISTINCT over the trip
columns. The plan here is therefore: distinct trips -> broadcast hash join to the per-state
averages. Trips of states without demographics are dropped before the distinct's shuffle by a
map-side semi join against the same small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.operators.joins import bounded_broadcast

TRIP_COLUMNS = ["cic_id", "country_code_1", "country_code_2", "city_code", "arrive_date",
                "state_code", "depart_date", "visa_code", "birth_year", "gender", "airline",
                "flight_number"]
MEASURES = ["Median_Age", "Male_Population", "Female_Population", "Total_Population",
            "Number_of_Veterans", "Foreign_born"]
# What each trip takes from the averages of its state.
STATE_COLUMNS = [*(f"avg_{m}" for m in MEASURES), "demographics_state_code", "Race"]
FACT_COLUMNS = (
    ["cic_id", "country_code_1", "country_code_2", "city_code", "arrive_date",
     "immigration_state_code", "depart_date", "visa_code", "birth_year", "gender", "airline",
     "flight_number"]
    + STATE_COLUMNS
    + ["year", "month"]
)
# The trip columns identify a fact row (the rest follows from the state); incremental loads
# merge on them.
FACT_KEYS = ["immigration_state_code" if c == "state_code" else c for c in TRIP_COLUMNS]


def demographics_by_state(demographics: DataFrame, per_city: bool = False) -> DataFrame:
    """Per state code: average of the six measures, alphabetically largest State and Race.

    Rows are city x race, so by default a city with more race rows weighs more. With
    ``per_city=True`` each (state, city) is first reduced to its own averages.
    """
    rows = demographics
    if per_city:
        rows = rows.groupBy("State_Code", "City").agg(
            *[F.avg(m).alias(m) for m in MEASURES],
            F.max("State").alias("State"), F.max("Race").alias("Race"))
    return rows.groupBy("State_Code").agg(
        *[F.avg(m).alias(m) for m in MEASURES],
        F.max("State").alias("State"),
        F.max("Race").alias("Race"),
    )


def trip_grain(trips: DataFrame) -> DataFrame:
    """Staged trips without occupation, distinct: the grain of the fact table."""
    return trips.select(*TRIP_COLUMNS).distinct()


def state_side(by_state: DataFrame) -> DataFrame:
    """Per-state averages under their fact names (avoids the case-insensitive clash between
    ``state_code`` and ``State_Code``), broadcast when its row count is within the bound."""
    return bounded_broadcast(by_state.select(
        F.col("State_Code").alias("demographics_state_code"),
        *[F.col(m).alias(f"avg_{m}") for m in MEASURES],
        F.col("Race"),
    ))


def fact_trips(trips: DataFrame, demographics: DataFrame, by_state: DataFrame | None = None,
               side: DataFrame | None = None, deal_by: Sequence[str] = ()) -> DataFrame:
    """The fact: one row per distinct trip whose state has demographics.

    ``side`` is a prepared ``state_side`` (checked and persisted once by a caller that builds
    the fact many times, such as a stream); otherwise it is prepared here. ``deal_by`` rebalances the trips
    on partition columns before the state's columns are added, for a write that need not move the wider rows.
    """
    if side is None:
        side = state_side(by_state if by_state is not None else demographics_by_state(demographics))
    on_state = F.col("state_code") == F.col("demographics_state_code")
    covered = trips.join(side.select("demographics_state_code"), on_state, "left_semi")
    trips = trip_grain(covered).withColumns({"year": F.year("arrive_date"), "month": F.month("arrive_date")})
    if deal_by:
        trips = trips.hint("rebalance", *deal_by)
    joined = trips.join(side, on_state, "inner")
    trip_cols = [F.col(c).alias("immigration_state_code") if c == "state_code" else F.col(c)
                 for c in TRIP_COLUMNS]
    return joined.select(
        *trip_cols,
        *[F.col(f"avg_{m}") for m in MEASURES],
        F.col("demographics_state_code"),
        F.col("Race"),
        F.col("year"),
        F.col("month"),
    )


def fact_trips_grouped(trips: DataFrame, demographics: DataFrame) -> DataFrame:
    """The fact with an aggregate after the join, as first formulated (kept for comparison).

    Staged trips (occupation included) are joined to the per-state averages and then grouped by
    every trip column plus the state's code, race, year and month, averaging the averages again.
    Each trip meets one row of averages, so the result equals ``fact_trips``; the extra GROUP BY
    costs a shuffle of the joined trips, which is what the bench measures.
    """
    side = demographics_by_state(demographics).select(
        F.col("State_Code").alias("demographics_state_code"), *MEASURES, F.col("Race"))
    joined = trips.join(side, F.col("state_code") == F.col("demographics_state_code"), "inner")
    keys = [F.col(c).alias("immigration_state_code") if c == "state_code" else F.col(c)
            for c in TRIP_COLUMNS]
    keys += [F.col("demographics_state_code"), F.col("Race"),
             F.year("arrive_date").alias("year"), F.month("arrive_date").alias("month")]
    grouped = joined.groupBy(*keys).agg(*[F.avg(m).alias(f"avg_{m}") for m in MEASURES])
    return grouped.select(*FACT_COLUMNS)


def unmatched_states(trips: DataFrame, demographics: DataFrame, by_state: DataFrame | None = None) -> DataFrame:
    """Trips (fact grain) whose state code finds no demographics, counted per state code.

    Null state codes never match and are reported as their own row.
    """
    side = state_side(by_state if by_state is not None else demographics_by_state(demographics))
    orphans = trip_grain(trips).join(side.select("demographics_state_code"),
                                     F.col("state_code") == F.col("demographics_state_code"),
                                     "left_anti")
    return orphans.groupBy("state_code").agg(F.count(F.lit(1)).alias("trips"))
