"""Loads that tell what they changed, pruned merges, and malformed lines."""

import datetime as dt

from pyspark.sql import functions as F

from portstar.plans.bi import daily_summary
from portstar.plans.maintenance import LoadResult, incremental_load, refresh_derived
from portstar.session import scratch_path
from portstar.sources import read_arrivals
from portstar.sources.readers import read_demographics, read_table, rejected_arrivals, rejected_demographics
from portstar.sources.schemas import ARRIVALS_SCHEMA, DEMOGRAPHICS_SCHEMA

FACT = "id long, arrive_date date, immigration_state_code string, avg_Total_Population double, year int, month int"


def _fact(spark, rows):
    return spark.createDataFrame([(i, dt.date(2016, m, 5), "CA", 1.0, 2016, m) for i, m in rows], FACT)


def _by_month(df):
    return {(r.year, r.month): r.n for r in df.groupBy("year", "month").agg(F.sum("trips").alias("n")).collect()}


def test_summary_follows_rows_that_leave_a_month_and_empty_months_go(spark):
    table, summary = scratch_path(spark, "moved"), scratch_path(spark, "moved-summary")
    parts = ("year", "month")
    for rows in ([(1, 1), (2, 1), (3, 2), (4, 3)], [(2, 2), (4, 2)], [(1, 4), (5, 4)]):
        done = incremental_load(spark, table, _fact(spark, rows), ["id"], parts)
        assert isinstance(done, LoadResult) and {(2016, m) for _, m in rows} <= set(done.touched)
        schema = _fact(spark, []).schema
        refresh_derived(spark, table, schema, summary, daily_summary, done.touched)
        got = read_table(spark, summary, daily_summary(_fact(spark, [])).schema)
        assert _by_month(got) == _by_month(daily_summary(read_table(spark, table, schema)))
    assert _by_month(got) == {(2016, 2): 3, (2016, 4): 2}         # January and March are gone


def test_a_pruned_merge_opens_the_increments_partitions_only(spark, monkeypatch):
    from portstar.plans import maintenance

    table, parts = scratch_path(spark, "pruned"), ("year", "month")
    keys = ["id", "arrive_date"]
    incremental_load(spark, table, _fact(spark, [(i, 1 + i % 6) for i in range(60)]), keys, parts)
    filters = []
    keep = maintenance.partition_filter
    monkeypatch.setattr(maintenance, "partition_filter", lambda v, p: filters.append(sorted(v)) or keep(v, p))
    again = _fact(spark, [(6, 1), (900, 1)]).withColumn("avg_Total_Population", F.lit(2.0))
    incremental_load(spark, table, again, keys, parts, keys_fix_partition=True)
    assert filters[0] == [(2016, 1)]
    scan = read_table(spark, table, again.schema).where(keep(filters[0], parts))
    assert {r.month for r in scan.select("month").distinct().collect()} == {1}
    assert scan.select(F.input_file_name()).distinct().count() < len(scan.inputFiles())     # pruned by folder
    rows = {r.id: r.avg_Total_Population for r in read_table(spark, table, again.schema).collect()}
    assert len(rows) == 61 and rows[6] == 2.0 and rows[900] == 2.0 and rows[7] == 1.0


LINE = ["1.0", "209.0", "582.0", "NYC", "20545.0", "CA", "20550.0", "1.0", "", "1980.0", "F", "AA", "100"]


def test_lines_with_too_few_or_too_many_fields_are_listed_not_nulled(spark, tmp_path):
    path = str(tmp_path / "torn.csv")
    lines = [",".join(LINE), ",".join(LINE[:5]), ",".join([*LINE, "x", "y"]), ",".join(["2.0", *LINE[1:]]),
             ",".join(["x3", *LINE[1:]]), '4.0,"209.0"' + "," + ",".join(LINE[2:])]
    with open(path, "w") as f:
        f.write(",".join(x.name for x in ARRIVALS_SCHEMA.fields) + "\n" + "\n".join(lines) + "\n")
    df = read_arrivals(spark, path, fmt="csv")
    assert sorted(r.cicid for r in df.collect()) == [1.0, 2.0, 4.0] and df.count() == 3
    bad = {r.line: list(r.bad_columns) for r in rejected_arrivals(spark, path).collect()}
    assert bad == {lines[1]: ["_corrupt_record"], lines[2]: ["_corrupt_record"], None: ["cicid"]}
    assert rejected_arrivals(spark, path).count() == 3            # whatever columns a caller asks for
    assert rejected_arrivals(spark, path).select("cicid").count() == 3


def test_malformed_demographics_lines(spark, tmp_path):
    path = str(tmp_path / "cities.csv")
    cells = ["Town", "State", "35.5", "10", "11", "21", "1", "2", "2.5", "CA", "Asian", "5"]
    with open(path, "w") as f:
        f.write(";".join(x.name for x in DEMOGRAPHICS_SCHEMA.fields) + "\n")
        f.write("\n".join([";".join(cells), ";".join(cells[:3]), ";".join([*cells, "more"])]) + "\n")
    assert read_demographics(spark, path).count() == 1
    assert sorted(len(r.line.split(";")) for r in rejected_demographics(spark, path).collect()) == [3, 13]
