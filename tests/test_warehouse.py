import os

from pyspark.sql import functions as F

from portstar.plans.bi import population_by_state_month
from portstar.plans.contract import validate_contract
from portstar.plans.quality import key_report
from portstar.plans.warehouse import LAYOUT, Warehouse
from portstar.session import scratch_path
from portstar.sources.testdata import arrivals_from_testdata, demographics_from_testdata


def test_build_writes_every_table_and_checks_pass_on_written_data(spark, sf_small):
    wh = Warehouse(spark, scratch_path(spark, "test-warehouse"))
    results = wh.build(arrivals_from_testdata(spark, sf_small), demographics_from_testdata(spark, sf_small))
    assert [r.table for r in results] == list(LAYOUT)
    for name, parts in LAYOUT.items():
        path = wh.path(name).removeprefix("file:")
        files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
        assert files, name
        if parts:
            assert any(d.startswith(f"{parts[0]}=") for d in os.listdir(path))
    tables = {name: wh.table(name) for name in LAYOUT}
    assert tables["stage_immigration"].columns[5] == "state_code"  # schema order kept on read
    report = key_report({
        "dim_immi_personel": (tables["dim_immi_personel"], "cic_id"),
        "dim_immi_airline": (tables["dim_immi_airline"], "travel_id"),
        "dim_arrive_calendar": (tables["dim_arrive_calendar"], "arrive_date"),
        "dim_depart_calendar": (tables["dim_depart_calendar"], "depart_date"),
        "demo_population_dim": (tables["demo_population_dim"], "demo_pop_id"),
    })
    assert {r.verdict for r in report.collect()} == {"ok"}
    contract = validate_contract(spark, tables)
    assert contract.where(F.col("violations") > 0).isEmpty()
    views = wh.register_views(prefix="t_")
    assert "t_immi_demographics" in views
    sql_check = spark.sql("""
        SELECT count(*) AS total_rows, count(immigration_state_code) AS with_state,
               count(demographics_state_code) AS with_demographics
        FROM t_immi_demographics""").first()
    assert sql_check.total_rows == sql_check.with_state == sql_check.with_demographics
    reports = wh.quality_reports()
    assert reports["merge_report"].first().fact_rows == tables["immi_demographics"].count()
    assert reports["person_null_check"].first().checked_rows == tables["dim_immi_personel"].count()
    assert reports["schema_contract"].where(F.col("violations") > 0).isEmpty()
    bi = population_by_state_month(tables["immi_demographics"])
    assert bi.agg(F.sum("trips")).first()[0] == tables["immi_demographics"].count()


def test_entry_runs_flagship_on_smoke_data(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["year", "month", "immigration_state_code", "trips", "avg_population"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_results_do_not_depend_on_session_time_zone(spark, sf_small):
    from portstar.registry import QUERIES

    names = ["event_calendar", "dim_arrive_calendar", "stage_trips"]
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    try:
        results = {}
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set(key, zone)
            results[zone] = {n: sorted(map(str, QUERIES[n](spark, sf_small).collect())) for n in names}
    finally:
        spark.conf.set(key, before)
    assert results["UTC"] == results["America/Los_Angeles"] == results["Asia/Kolkata"]
