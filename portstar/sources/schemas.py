"""Declared schemas of the two raw inputs and their staged column names.

Schemas are explicit: inference costs an extra pass over the input and changes with the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 13 arrival-record columns kept from the source, in source order, and the
# staged names they are given (same order).
ARRIVAL_SOURCE_COLUMNS = [
    "cicid", "i94cit", "i94res", "i94port", "arrdate", "i94addr", "depdate", "i94visa",
    "occup", "biryear", "gender", "airline", "fltno",
]
ARRIVAL_STAGED_COLUMNS = [
    "cic_id", "country_code_1", "country_code_2", "city_code", "arrive_date", "state_code",
    "depart_date", "visa_code", "occupation", "birth_year", "gender", "airline", "flight_number",
]

# SAS stores every numeric as a double.
_ARRIVAL_TYPES = {
    "cicid": T.DoubleType(), "i94cit": T.DoubleType(), "i94res": T.DoubleType(),
    "i94port": T.StringType(), "arrdate": T.DoubleType(), "i94addr": T.StringType(),
    "depdate": T.DoubleType(), "i94visa": T.DoubleType(), "occup": T.StringType(),
    "biryear": T.DoubleType(), "gender": T.StringType(), "airline": T.StringType(),
    "fltno": T.StringType(),
}
ARRIVALS_SCHEMA = T.StructType(
    [T.StructField(name, _ARRIVAL_TYPES[name], True) for name in ARRIVAL_SOURCE_COLUMNS])

# The 12 city-demographics columns of the ';' separated file, in file order.
DEMOGRAPHIC_SOURCE_COLUMNS = [
    "City", "State", "Median Age", "Male Population", "Female Population", "Total Population",
    "Number of Veterans", "Foreign-born", "Average Household Size", "State Code", "Race", "Count",
]
_DEMOGRAPHIC_TYPES = [
    T.StringType(), T.StringType(), T.DoubleType(), T.IntegerType(), T.IntegerType(),
    T.IntegerType(), T.IntegerType(), T.IntegerType(), T.DoubleType(), T.StringType(),
    T.StringType(), T.IntegerType(),
]
DEMOGRAPHICS_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in zip(DEMOGRAPHIC_SOURCE_COLUMNS, _DEMOGRAPHIC_TYPES)])


def staged_name(source_name: str) -> str:
    """Demographic staged names: spaces and hyphens become underscores."""
    return source_name.replace(" ", "_").replace("-", "_")


DEMOGRAPHIC_STAGED_COLUMNS = [staged_name(n) for n in DEMOGRAPHIC_SOURCE_COLUMNS]

# Typed staging schema of the trips (what ``stage_trips`` produces).
STAGED_TRIPS_SCHEMA = T.StructType([
    T.StructField("cic_id", T.LongType()),
    T.StructField("country_code_1", T.StringType()),
    T.StructField("country_code_2", T.StringType()),
    T.StructField("city_code", T.StringType()),
    T.StructField("arrive_date", T.DateType()),
    T.StructField("state_code", T.StringType()),
    T.StructField("depart_date", T.DateType()),
    T.StructField("visa_code", T.IntegerType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("birth_year", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("airline", T.StringType()),
    T.StructField("flight_number", T.StringType()),
])

STAGED_DEMOGRAPHICS_SCHEMA = T.StructType(
    [T.StructField(staged_name(f.name), f.dataType, True) for f in DEMOGRAPHICS_SCHEMA.fields])
