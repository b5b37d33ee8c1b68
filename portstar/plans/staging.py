"""Staging: select, name, type and deduplicate the two raw inputs."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portstar.functions.dates import in_calendar, sas_date
from portstar.functions.numbers import code_text, whole_number
from portstar.operators.columns import rename_columns
from portstar.sources.schemas import (
    ARRIVAL_SOURCE_COLUMNS,
    ARRIVAL_STAGED_COLUMNS,
    DEMOGRAPHIC_SOURCE_COLUMNS,
    DEMOGRAPHIC_STAGED_COLUMNS,
)


def stage_trips(arrivals: DataFrame) -> DataFrame:
    """13 source columns -> staged names and declared types -> distinct rows.

    Distinct runs on the typed rows, so every staged row is unique as stored.
    """
    return typed_trips(arrivals).distinct()


def typed_trips(arrivals: DataFrame) -> DataFrame:
    """Ids and codes become whole numbers, SAS day numbers become dates. Rows with a number that is
    neither (a fraction, NaN, a day outside the calendar) are left to :func:`rejected_trips`, so
    that no two of them merge.
    """
    good = reduce(and_, [~F.coalesce(bad, F.lit(False)) for bad in _bad_cells().values()])
    arrivals = arrivals.select(*ARRIVAL_SOURCE_COLUMNS).where(good)
    named = rename_columns(arrivals, ARRIVAL_STAGED_COLUMNS)
    return named.select(
        whole_number("cic_id", "bigint").alias("cic_id"),
        code_text("country_code_1").alias("country_code_1"),
        code_text("country_code_2").alias("country_code_2"),
        F.col("city_code"),
        sas_date("arrive_date").alias("arrive_date"),
        F.col("state_code"),
        sas_date("depart_date").alias("depart_date"),
        whole_number("visa_code", "int").alias("visa_code"),
        F.col("occupation"),
        whole_number("birth_year", "int").alias("birth_year"),
        F.col("gender"),
        F.col("airline"),
        F.col("flight_number"),
    )


def _bad_cells() -> dict[str, Column]:
    """Source column -> whether it holds a number ``typed_trips`` cannot type."""
    good = {"cicid": whole_number("cicid", "bigint").isNotNull(),
            "i94cit": code_text("i94cit").isNotNull(), "i94res": code_text("i94res").isNotNull(),
            "arrdate": in_calendar("arrdate"), "depdate": in_calendar("depdate"),
            "i94visa": whole_number("i94visa", "int").isNotNull(),
            "biryear": whole_number("biryear", "int").isNotNull()}
    return {c: F.col(c).isNotNull() & ~ok for c, ok in good.items()}


def _bad_columns() -> Column:
    """Names of the bad cells of a row."""
    marks = [F.when(bad, F.lit(c)) for c, bad in _bad_cells().items()]
    return F.filter(F.array(*marks), lambda name: name.isNotNull())


def rejected_trips(arrivals: DataFrame) -> DataFrame:
    """The arrival rows that staging leaves out, as they came (repeats included), with the names of
    their ``bad_columns``. Staged rows, their repeats and these are all rows of the input."""
    rows = arrivals.select(*ARRIVAL_SOURCE_COLUMNS, F.array_join(_bad_columns(), ",").alias("bad_columns"))
    return rows.where(F.col("bad_columns") != "")


def stage_demographics(demographics: DataFrame) -> DataFrame:
    """12 source columns -> underscore names -> distinct rows (one row per city and race)."""
    picked = demographics.select(*[F.col(f"`{c}`") for c in DEMOGRAPHIC_SOURCE_COLUMNS])
    return rename_columns(picked, DEMOGRAPHIC_STAGED_COLUMNS).distinct()
