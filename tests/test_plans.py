import datetime as dt

from pyspark.sql import functions as F

from portstar.plans import dims
from portstar.plans.bi import population_by_state_month
from portstar.plans.fact import fact_trips, fact_trips_grouped, trip_grain, unmatched_states
from portstar.plans.quality import key_report, merge_report, missing_value_rows
from portstar.plans.staging import stage_demographics, stage_trips
from portstar.session import scratch_path
from portstar.sources import TableSpec, read_table, write_table
from portstar.sources.schemas import ARRIVALS_SCHEMA, DEMOGRAPHICS_SCHEMA, STAGED_TRIPS_SCHEMA


def arrival(cicid, state, arr=20545.0, dep=20550.0, occup=None, city="NYC", gender="F"):
    return (cicid, 209.0, 582.0, city, arr, state, dep, 1.0, occup, 1980.0, gender, "AA", "100")


def demo_row(state_code, city="Town", race="Asian", total=1000):
    return (city, "State " + state_code, 35.5, total // 2, total // 2, total, 10, 20, 2.5,
            state_code, race, 5)


def frames(spark, arrivals, demos):
    return (stage_trips(spark.createDataFrame(arrivals, ARRIVALS_SCHEMA)),
            stage_demographics(spark.createDataFrame(demos, DEMOGRAPHICS_SCHEMA)))


def test_occupation_only_difference_merges_in_fact(spark):
    trips, demo = frames(spark, [arrival(1.0, "CA", occup="A"), arrival(1.0, "CA", occup="B")],
                         [demo_row("CA")])
    assert trips.count() == 2
    assert fact_trips(trips, demo).count() == 1
    assert fact_trips_grouped(trips, demo).count() == 1


def test_state_matching_and_unmatched_report(spark):
    trips, demo = frames(spark, [arrival(1.0, "CA"), arrival(2.0, "ZZ"), arrival(3.0, None)],
                         [demo_row("CA"), demo_row("CA", city="Other", total=3000)])
    fact = fact_trips(trips, demo).collect()
    assert [r.immigration_state_code for r in fact] == ["CA"]
    assert fact[0].avg_Total_Population == 2000.0
    orphans = {r.state_code: r.trips for r in unmatched_states(trips, demo).collect()}
    assert orphans == {"ZZ": 1, None: 1}
    report = merge_report(trips, demo).first()
    assert (report.trip_rows, report.fact_rows, report.null_state_trips,
            report.unmatched_state_trips, report.verdict) == (3, 1, 1, 1, "trips dropped by the join")


def test_fact_rows_plus_unmatched_equal_trip_grain(spark, sf_small):
    from portstar.sources.testdata import arrivals_from_testdata, demographics_from_testdata

    trips = stage_trips(arrivals_from_testdata(spark, sf_small))
    demo = stage_demographics(demographics_from_testdata(spark, sf_small))
    unmatched = unmatched_states(trips, demo).agg(F.sum("trips")).first()[0]
    assert fact_trips(trips, demo).count() + unmatched == trip_grain(trips).count()


def test_person_dim_drops_null_ids_and_dedups(spark):
    trips, _ = frames(spark, [arrival(1.0, "CA", gender="M"), arrival(1.0, "CA", gender="F", arr=20546.0),
                              arrival(None, "CA")], [demo_row("CA")])
    people = dims.dim_person(trips).collect()
    assert [(r.cic_id, r.gender) for r in people] == [(1, "F")]


def test_airline_dim_keys_unique_with_null_city(spark):
    trips, _ = frames(spark, [arrival(1.0, "CA", city=None), arrival(12.0, "CA", city="A"),
                              arrival(1.0, "CA", city="2A")], [demo_row("CA")])
    rows = dims.dim_airline(trips).collect()
    ids = [r.travel_id for r in rows]
    assert None not in ids and len(set(ids)) == 3
    assert all(len(i) <= 20 for i in ids)


def test_departure_calendar_skips_null_and_missing_check_lists_it(spark):
    trips, _ = frames(spark, [arrival(1.0, "CA", dep=None), arrival(2.0, "CA", dep=20600.0)],
                      [demo_row("CA")])
    cal = dims.dim_depart_calendar(trips).collect()
    assert [r.depart_date for r in cal] == [dt.date(2016, 5, 26)]
    assert cal[0].week == 22 and cal[0].day == 26
    assert [r.cic_id for r in missing_value_rows(trips, "depart_date").collect()] == [1]


def test_key_report_separates_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    row = key_report({"t": (df, "k")}).first()
    assert (row.total_rows, row.distinct_keys, row.non_null_keys, row.null_keys,
            row.duplicate_rows, row.verdict) == (4, 2, 3, 1, 1, "null and duplicate keys")


def test_key_report_sketch_mode_runs_and_is_close(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("k"))
    exact = key_report({"t": (df, "k")}).first()
    approx = key_report({"t": (df, "k")}, approx=True).first()
    assert exact.distinct_keys == 1000
    assert abs(approx.distinct_keys - 1000) <= 50  # the sketch's default error is 5 %


def test_partition_round_trip_keeps_null_and_leading_zero(spark):
    trips, _ = frames(spark, [arrival(1.0, "07"), arrival(2.0, None)], [demo_row("07")])
    path = scratch_path(spark, "test-roundtrip")
    write_table(trips, TableSpec("stage", path, ("state_code",)))
    back = read_table(spark, path, STAGED_TRIPS_SCHEMA)
    assert back.columns == trips.columns
    assert sorted((r.cic_id, r.state_code) for r in back.collect()) == [(1, "07"), (2, None)]


def test_fact_plan_broadcasts_and_has_no_python(spark, sf_small):
    from portstar.sources.testdata import arrivals_from_testdata, demographics_from_testdata

    trips = stage_trips(arrivals_from_testdata(spark, sf_small))
    demo = stage_demographics(demographics_from_testdata(spark, sf_small))
    fact = fact_trips(trips, demo)
    fact.count()
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_year_filter_prunes_partitions_and_state_filter_is_pushed(spark, sf_small):
    from portstar.sources.testdata import arrivals_from_testdata, demographics_from_testdata

    trips = stage_trips(arrivals_from_testdata(spark, sf_small))
    demo = stage_demographics(demographics_from_testdata(spark, sf_small))
    fact = fact_trips(trips, demo)
    path = scratch_path(spark, "test-fact")
    write_table(fact, TableSpec("fact", path, ("year", "month")))
    written = read_table(spark, path, fact.schema)
    q = population_by_state_month(written, year=1998, state="12")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert "PushedFilters: [IsNotNull(immigration_state_code), EqualTo(immigration_state_code,12)]" in plan
    lazy = population_by_state_month(fact, year=1998, state="12")
    assert sorted(q.collect()) == sorted(lazy.collect())


def test_calendar_is_the_set_of_distinct_non_null_dates(spark, sf_small):
    from portstar.sources.testdata import arrivals_from_testdata

    trips = stage_trips(arrivals_from_testdata(spark, sf_small))
    for dim, col in [(dims.dim_arrive_calendar(trips), "arrive_date"),
                     (dims.dim_depart_calendar(trips), "depart_date")]:
        want = {r[0] for r in trips.select(col).where(F.col(col).isNotNull()).distinct().collect()}
        got = [r[0] for r in dim.select(col).collect()]
        assert len(got) == len(set(got)) and set(got) == want
