"""Dimension tables of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.functions.dates import calendar_columns, iso_week_year, week_iso, week_us
from portstar.functions.keys import travel_key
from portstar.operators.dedup import dedup_by_key
from portstar.operators.surrogate import dense_key
from portstar.sources.schemas import ARRIVAL_STAGED_COLUMNS

PERSON_COLUMNS = ["cic_id", "country_code_1", "country_code_2", "birth_year", "gender"]
AIRLINE_COLUMNS = ["city_code", "airline", "flight_number", "visa_code"]
POPULATION_COLUMNS = ["State", "Median_Age", "Male_Population", "Female_Population",
                      "Total_Population", "Foreign_born", "State_Code", "Race"]
# Numbering order of demographic rows: state, city, race first, then every other column.
POPULATION_ORDER = ["State_Code", "City", "Race", "State", "Median_Age", "Male_Population",
                    "Female_Population", "Total_Population", "Number_of_Veterans",
                    "Foreign_born", "Average_Household_Size", "Count"]


def dim_person(trips: DataFrame) -> DataFrame:
    """One row per traveller id: the row with the smallest (country_code_1, country_code_2,
    birth_year, gender), filled values before nulls. Rows without an id are left out."""
    people = trips.select(*PERSON_COLUMNS).where(F.col("cic_id").isNotNull())
    return dedup_by_key(people, ["cic_id"], order_by=PERSON_COLUMNS[1:])


def dim_airline(trips: DataFrame, path: str | None = None, parts: int = 1) -> DataFrame:
    """One row per staged trip with a dense travel id ``<n>-<city_code>``.

    n numbers the staged rows in the order (cic_id, then every other staged column), a total
    order because staged rows are distinct.
    """
    numbered = dense_key(trips.select(*ARRIVAL_STAGED_COLUMNS), ARRIVAL_STAGED_COLUMNS,
                         "_trip_no", keep=AIRLINE_COLUMNS, path=path, parts=parts)
    return numbered.select(travel_key(F.col("_trip_no"), F.col("city_code")).alias("travel_id"),
                           *AIRLINE_COLUMNS)


def _calendar(trips: DataFrame, date_col: str) -> DataFrame:
    days = trips.select(date_col).where(F.col(date_col).isNotNull()).distinct()
    return days.select(F.col(date_col), *calendar_columns(date_col))


def dim_arrive_calendar(trips: DataFrame) -> DataFrame:
    """arrive_date, year, month, week (US), day for every distinct arrival date."""
    return _calendar(trips, "arrive_date")


def dim_depart_calendar(trips: DataFrame) -> DataFrame:
    """depart_date, year, month, week (US), day for every distinct, non-null departure date."""
    return _calendar(trips, "depart_date")


def iso_week_calendar(trips: DataFrame, date_col: str = "arrive_date") -> DataFrame:
    """Both week numberings side by side: US (Sunday start) and ISO (Monday start)."""
    days = trips.select(date_col).where(F.col(date_col).isNotNull()).distinct()
    d = F.col(date_col)
    return days.select(d, F.year(d).alias("year"), week_us(d).alias("week_us"),
                       iso_week_year(d).alias("iso_year"), week_iso(d).alias("week_iso"))


def dim_population(demographics: DataFrame, path: str | None = None) -> DataFrame:
    """One row per staged demographic row with a dense ``demo_pop_id``."""
    numbered = dense_key(demographics.select(*POPULATION_ORDER), POPULATION_ORDER,
                         "demo_pop_id", keep=POPULATION_COLUMNS, path=path)
    return numbered.select("demo_pop_id", *POPULATION_COLUMNS)
