"""Rows are moved as often as a job needs, not more."""

import pytest
from pyspark.sql import functions as F

from portstar.plans import maintenance
from portstar.plans.fact import demographics_by_state, fact_trips
from portstar.plans.snapshots import SnapshotStore
from portstar.plans.staging import stage_demographics, stage_trips
from portstar.session import scratch_path
from portstar.sources import TableSpec, read_table, write_table
from portstar.streaming import incremental
from tests.test_maintenance import _warehouse_inputs


@pytest.fixture
def specs(monkeypatch):
    """The specs of the writes in plans.maintenance."""
    seen, write = [], maintenance.write_table
    monkeypatch.setattr(maintenance, "write_table", lambda df, spec, *a: seen.append(spec) or write(df, spec, *a))
    return seen


def test_dealt_rows_are_written_by_the_tasks_that_hold_them(spark):
    df = spark.range(100).withColumn("p", F.lit(1)).repartition(4)
    counts = {}
    for dealt in (False, True):
        path = scratch_path(spark, "test-dealt")
        write_table(df, TableSpec("t", path, ("p",), dealt=dealt))
        counts[dealt] = len(spark.read.parquet(path).inputFiles())
        assert spark.read.parquet(path).count() == 100
    assert counts == {False: 1, True: 4}


def test_archive_split_does_not_shuffle(spark, specs):
    path, archive, live = (scratch_path(spark, f"test-{n}") for n in ("whole", "archive", "live"))
    rows = [(1, 1997, 12), (2, 1998, 1), (3, None, None), (4, 1990, 5), (4, 1990, 5)]
    df = spark.createDataFrame(rows, "id long, year int, month int")
    write_table(df, TableSpec("t", path, ("year", "month")))
    maintenance.archive_split(spark, path, archive, live, df.schema, 1998, 1)
    assert [s.dealt for s in specs] == [True, True]
    assert sorted(r.id for r in read_table(spark, archive, df.schema).collect()) == [1, 4, 4]
    assert sorted(r.id for r in read_table(spark, live, df.schema).collect()) == [2, 3]


def test_increment_is_staged_once_and_its_rewritten_months_are_not_dealt_again(spark, specs):
    path, schema = scratch_path(spark, "test-staged"), "id long, name string, year int, month int"
    first = spark.createDataFrame([(1, "a", 2020, 1), (2, "b", 2020, 2), (3, "c", None, None)], schema)
    done = maintenance.incremental_load(spark, path, first, ["id"], ("year", "month"))
    assert len(specs) == 1 and set(done.touched) == {(2020, 1), (2020, 2), (None, None)}
    maintenance.incremental_load(spark, path, spark.createDataFrame([(2, "B", 2020, 1)], schema), ["id"], ("year", "month"))
    assert [s.dealt for s in specs if s.mode == "overwrite" and s.name == "target"] == [True]
    assert sorted((r.id, r.name) for r in read_table(spark, path, first.schema).collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_fact_is_dealt_before_the_state_columns(spark):
    arrivals, demo = _warehouse_inputs(spark)
    trips, demo = stage_trips(arrivals), stage_demographics(demo)
    dealt = fact_trips(trips, demo, deal_by=("year", "month"))
    assert sorted(dealt.collect()) == sorted(fact_trips(trips, demo).collect())
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("RebalancePartitions")


def test_stream_merges_once_for_all_batches_and_resumes(spark, monkeypatch):
    arrivals, demo = _warehouse_inputs(spark)
    source, target = scratch_path(spark, "test-once-src"), scratch_path(spark, "test-once-fact")
    for _ in range(2):                                   # every file comes twice
        for row in arrivals.collect():
            spark.createDataFrame([row], arrivals.schema).coalesce(1).write.mode("append").parquet(source)
    by_state = demographics_by_state(stage_demographics(demo))
    want = fact_trips(stage_trips(arrivals), stage_demographics(demo))
    checkpoint, calls, load = scratch_path(spark, "test-once-ck"), [], incremental.incremental_load

    def counted(*args, **kw):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("lost")
        return load(*args, **kw)

    monkeypatch.setattr(incremental, "incremental_load", counted)
    with pytest.raises(Exception, match="lost"):
        incremental.stream_arrivals_into_fact(spark, source, target, by_state, checkpoint)
    incremental.stream_arrivals_into_fact(spark, source, target, by_state, checkpoint)   # no new file, kept batches
    assert len(calls) == 2
    assert sorted(read_table(spark, target, want.schema).collect()) == sorted(want.collect())
    incremental.stream_arrivals_into_fact(spark, source, target, by_state, checkpoint)   # nothing left
    assert len(calls) == 2


def test_paths_are_decoded_for_each_file_not_for_each_row(spark):
    load = SnapshotStore(spark, scratch_path(spark, "test-paths")).begin()
    df = spark.range(10).withColumn("p", F.concat(F.lit("a b%+/"), (F.col("id") % 2).cast("string")))
    load.steps += 1
    files = load._write("t", "data", df, ("p",))
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert "url_decode" not in plan[plan.index("Aggregate"):].lower() and files.count() == 2
    load.replace("t", df, ("p",))
    assert sorted(map(tuple, load.table("t").collect())) == sorted(map(tuple, df.collect()))
