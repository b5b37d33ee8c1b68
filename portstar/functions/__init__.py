"""Column functions: pure Catalyst expressions, no Python UDFs."""

from portstar.functions.dates import (
    calendar_columns,
    sas_date,
    sas_day_number,
    sas_day_of,
    sas_timestamp,
    week_iso,
    week_us,
    with_sas_dates,
)
from portstar.functions.keys import travel_key
from portstar.functions.missing import is_blank, is_missing
from portstar.functions.numbers import code_text, whole_number

__all__ = [
    "calendar_columns", "sas_date", "sas_day_number", "sas_day_of", "sas_timestamp",
    "week_iso", "week_us", "with_sas_dates", "travel_key", "is_blank", "is_missing", "code_text", "whole_number",
]
