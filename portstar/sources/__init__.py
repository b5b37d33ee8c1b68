"""Sources (raw inputs, written tables, test-table stand-ins) and sinks."""

from portstar.sources.readers import (
    read_arrivals,
    read_demographics,
    read_table,
    read_testdata,
    register_views,
)
from portstar.sources.sinks import TableSpec, WriteResult, preview, write_csv, write_table
from portstar.sources.testdata import arrivals_from_testdata, demographics_from_testdata

__all__ = [
    "read_arrivals", "read_demographics", "read_table", "read_testdata", "register_views",
    "TableSpec", "WriteResult", "preview", "write_csv", "write_table",
    "arrivals_from_testdata", "demographics_from_testdata",
]
