"""Fast guards on the driver contract: names line up and every SQL statement plans in DuckDB."""

import __spark_entry__ as entry
from portstar.registry import QUERIES
from tests.harness import duck


def test_every_query_has_sql_and_names_line_up():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()


def test_every_sql_statement_plans_in_duckdb(sf_small):
    con = duck(sf_small)
    for name, text in entry.oracle_sql().items():
        con.execute(f"EXPLAIN {text}")  # raises on a syntax or binding error
