"""Date columns: SAS day numbers, US week numbering, calendar attributes.

All of these are Catalyst expressions (no Python UDF), so they stay inside whole-stage codegen and
do not depend on the session time zone: SAS days become ``date`` / ``timestamp_ntz`` values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from portstar.functions.numbers import as_column

# SAS counts days from 1960-01-01; 86,400 seconds per day.
SAS_EPOCH = "1960-01-01"
MICROS_PER_DAY = 86_400_000_000
# The day numbers of 0001-01-01 and 9999-12-31, the calendar a date column can hold.
SAS_DAY_MIN, SAS_DAY_MAX = -715_509, 2_936_549


def sas_date(c) -> Column:
    """SAS day number (double) -> ``date``; fractional days fall to the day they lie in.

    ``floor`` rather than a cast, so -0.5 is 1959-12-31. Null, NaN and out-of-range values give
    null instead of failing the job under ANSI mode.
    """
    c = as_column(c)
    days = F.floor(c).cast("int")
    return F.when(in_calendar(c), F.date_add(F.lit(SAS_EPOCH).cast("date"), days))


def in_calendar(c) -> Column:
    """Whether a SAS day number lies in the years 1 to 9999 (null for null; NaN does not)."""
    c = as_column(c)
    return (c >= SAS_DAY_MIN) & (c < SAS_DAY_MAX + 1)


def sas_timestamp(c) -> Column:
    """SAS day number (double) -> ``timestamp_ntz``, keeping the fraction (20545.5 -> 12:00).

    A naive timestamp, like the ``datetime`` the original conversion built, so the result does
    not move with ``spark.sql.session.timeZone``.
    """
    c = as_column(c)
    micros = F.round(c * F.lit(MICROS_PER_DAY)).cast("long")
    epoch = F.lit(f"{SAS_EPOCH} 00:00:00").cast("timestamp_ntz")
    return F.when(in_calendar(c), F.timestamp_add("MICROSECOND", micros, epoch))


def sas_day_number(c) -> Column:
    """``date`` or ``timestamp_ntz`` -> SAS day number (double), the inverse of the two above."""
    c = as_column(c)
    epoch = F.lit(f"{SAS_EPOCH} 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz"))
    return micros.cast("double") / F.lit(float(MICROS_PER_DAY))


def sas_day_of(c) -> Column:
    """``date``/``timestamp`` -> whole SAS day number (double) of the day it falls on."""
    c = as_column(c)
    return F.datediff(c.cast("date"), F.lit(SAS_EPOCH).cast("date")).cast("double")


def week_us(c) -> Column:
    """US week of year: weeks start on Sunday and the week holding 1 January is week 1.

    This is what the legacy ``w`` pattern printed in an en_US locale (Spark 3+ rejects ``w``).
    The Saturday closing the week of ``c`` decides: its day of year / 7, rounded up.
    """
    d = as_column(c).cast("date")
    saturday = F.date_add(d, F.lit(7) - F.dayofweek(d))
    return F.ceil(F.dayofyear(saturday) / F.lit(7)).cast("int")


def week_iso(c) -> Column:
    """ISO-8601 week of year (Monday start, week 1 holds the first Thursday)."""
    return F.weekofyear(as_column(c).cast("date"))


def iso_week_year(c) -> Column:
    """The year the ISO week belongs to: the year of that week's Thursday."""
    d = as_column(c).cast("date")
    return F.year(F.date_add(d, F.lit(4) - _iso_dow(d)))


def _iso_dow(d: Column) -> Column:
    # Monday = 1 ... Sunday = 7
    return ((F.dayofweek(d) + F.lit(5)) % F.lit(7)) + F.lit(1)


def calendar_columns(date_col: str) -> list[Column]:
    """Year, month, US week and day of month of a date column, all ``int``."""
    d = F.col(date_col)
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        week_us(d).alias("week"),
        F.dayofmonth(d).alias("day"),
    ]


def with_sas_dates(df, columns, as_timestamp: bool = False):
    """Replace SAS day-number columns by dates (or naive timestamps) in one ``withColumns``."""
    convert = sas_timestamp if as_timestamp else sas_date
    return df.withColumns({c: convert(c) for c in columns})
