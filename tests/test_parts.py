"""Tables made in parts: the same rows, and no more shuffle files than one part's on disk."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from portstar.operators.surrogate import dense_key
from portstar.plans import dims, parts
from portstar.plans.fact import demographics_by_state, fact_trips
from portstar.plans.publish import publish_warehouse
from portstar.plans.snapshots import SnapshotStore
from portstar.plans.staging import stage_demographics, stage_trips, typed_trips
from portstar.plans.warehouse import LAYOUT
from portstar.session import checkpoint_root, scratch_path, shuffles_freed
from portstar.sources import TableSpec, write_table
from tests.test_maintenance import _warehouse_inputs


def _rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def _shuffle_bytes(spark):
    jvm = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [d.getPath() for d in jvm.localDirs()]
    return sum(os.path.getsize(f) for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data") if os.path.exists(f))


def _scratch(spark):
    folder = f"{checkpoint_root(spark)}/portstar".removeprefix("file:")
    return {d for d in (os.listdir(folder) if os.path.isdir(folder) else ())
            if d.startswith(("typed-", "numbered-", "dense-"))}


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(parts, "PART_BYTES", 1)


def _inputs(spark):
    """Trips with repeated rows, null and common states, and rows that differ in occupation only."""
    arrivals, demo = _warehouse_inputs(spark)
    many = spark.range(40).select(F.col("id").alias("k"))
    more = arrivals.crossJoin(many).withColumns({
        "cicid": F.when(F.col("k") % 9 != 0, F.col("cicid") * 100 + F.col("k") % 20),
        "i94addr": F.when(F.col("k") % 7 == 0, None).when(F.col("k") % 3 == 0, F.lit("zz")).otherwise(F.col("i94addr")),
        "occup": F.when(F.col("k") < 20, F.lit("x"))}).drop("k")
    return arrivals.unionAll(more), demo


def test_a_write_deletes_its_shuffle_files(spark):
    for _ in range(3):
        spark._jvm.System.gc()
        time.sleep(0.3)
    before = _shuffle_bytes(spark)
    df = spark.range(200_000).select((F.xxhash64("id") % 50_000).alias("k")).distinct()
    write_table(df, TableSpec("t", scratch_path(spark, "test-freed")))
    for _ in range(50):
        if _shuffle_bytes(spark) - before < 50_000:
            break
        time.sleep(0.1)
    assert _shuffle_bytes(spark) - before < 50_000


def test_the_setting_comes_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError):
        with shuffles_freed(spark), shuffles_freed(spark):
            assert spark.conf.get(key) == "true"
            raise ValueError
    assert spark.conf.get(key, None) == before
    spark.conf.set(key, "false")
    with shuffles_freed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == "false"
    spark.conf.unset(key)


def test_staged_trips_in_parts_are_the_staged_trips(spark, small_parts):
    arrivals, _ = _inputs(spark)
    found = []
    before = _scratch(spark)
    for part in parts.staged_trips(arrivals):
        found.append(_rows(part))
    assert len(found) == parts.PARTS[-1] and sum(map(bool, found)) > 1
    assert sorted(sum(found, [])) == _rows(stage_trips(arrivals))
    assert typed_trips(arrivals).count() > sum(map(len, found))
    assert _scratch(spark) == before


def test_parts_by_state_hold_each_trip_once_and_equal_trips_together(spark):
    arrivals, demo = _inputs(spark)
    trips, demo = stage_trips(arrivals), stage_demographics(demo)
    cut = parts.by_state(trips, 3)
    assert len(cut) >= 3 and max(p.count() for p in cut) < trips.count() / 2
    assert sorted(sum((_rows(p) for p in cut), [])) == _rows(trips)
    facts = [_rows(fact_trips(p, demo, demographics_by_state(demo))) for p in cut]
    assert sorted(sum(facts, [])) == _rows(fact_trips(trips, demo))
    assert parts.by_state(trips, 1) == [trips] and len(parts.by_state(trips.limit(0), 3)) == 1


def test_numbering_in_parts_gives_the_same_numbers(spark):
    df = spark.range(300).select((F.when(F.col("id") % 10 != 0, F.col("id") % 23)).alias("a"), F.col("id").alias("b"))
    whole = _rows(dense_key(df, ["a", "b"], "n"))
    for n in (2, 5, 50):
        path = scratch_path(spark, "test-numbered")
        assert _rows(dense_key(df, ["a", "b"], "n", path=path, parts=n)) == whole
    assert _rows(dense_key(df, ["a", "b"], "n", path=path)) == whole                     # parts of before are gone
    text = df.withColumn("a", F.col("a").cast("string"))
    assert dense_key(text, ["a", "b"], "n", parts=3).agg(F.max("n")).first()[0] == 300
    assert _rows(dense_key(df.withColumn("a", F.lit(None).cast("long")), ["a", "b"], "n", parts=3))[0] == "(1, None, 0)"


def test_a_published_build_in_parts_has_the_same_tables(spark, small_parts):
    arrivals, demo = _inputs(spark)
    store, before = SnapshotStore(spark, scratch_path(spark, "test-parts")), _scratch(spark)
    publish_warehouse(store, arrivals, demo, audit=None)
    trips, cities = stage_trips(arrivals), stage_demographics(demo)
    want = {"stage_immigration": trips, "dim_immi_personel": dims.dim_person(trips),
            "dim_immi_airline": dims.dim_airline(trips), "immi_demographics": fact_trips(trips, cities)}
    assert set(store.version().tables) == set(LAYOUT)
    for name, df in want.items():
        assert _rows(store.table(name)) == _rows(df), name
    assert {d for d in _scratch(spark) - before if not d.startswith("dense-")} == set()


def test_a_warehouse_in_parts_has_the_same_tables_and_writes_large_ones_in_turn(spark, small_parts, monkeypatch):
    from portstar.plans import warehouse

    arrivals, demo = _inputs(spark)
    running, most, write = [], [], warehouse.write_parts

    def seen(rows, spec):
        if spec.name in ("dim_immi_personel", "dim_immi_airline", "immi_demographics"):
            running.append(spec.name)
            most.append(len(running))
        try:
            return write(rows, spec)
        finally:
            if spec.name in running:
                running.remove(spec.name)

    monkeypatch.setattr(warehouse, "write_parts", seen)
    house, before = warehouse.Warehouse(spark, scratch_path(spark, "test-house")), _scratch(spark)
    assert [r.table for r in house.build(arrivals, demo)] == list(LAYOUT)
    assert max(most) == 1 and _scratch(spark) == before
    trips, cities = stage_trips(arrivals), stage_demographics(demo)
    want = {"stage_immigration": trips, "dim_immi_personel": dims.dim_person(trips),
            "dim_immi_airline": dims.dim_airline(trips), "immi_demographics": fact_trips(trips, cities)}
    for name, df in want.items():
        assert _rows(house.table(name)) == _rows(df), name
