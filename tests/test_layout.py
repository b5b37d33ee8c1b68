"""Files read for a day, a state and both: Z order against the partitioned layout."""

import bisect
import datetime as dt

import pytest
from pyspark.sql import functions as F

from portstar.plans.layout import _place, files_for, read_z_ordered, write_z_ordered, z_value
from portstar.session import scratch_path

FILES = 64


@pytest.fixture(scope="module")
def table(spark):
    n = 40_000
    return spark.range(n).select(
        F.date_add(F.lit("2016-01-01").cast("date"), (F.xxhash64("id", F.lit(1)) % 360 + 360).cast("int") % 360).alias("day"),
        F.format_string("S%02d", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(40))).alias("state"),
        F.pmod(F.xxhash64("id", F.lit(3)), F.lit(100_000)).alias("id"))


def test_any_of_the_columns_skips_files(spark, table):
    path, flat = scratch_path(spark, "z"), scratch_path(spark, "parts")
    write_z_ordered(table, path, ["day", "state", "id"], FILES)
    table.withColumn("month", F.month("day")).repartition("month").write.partitionBy("month").parquet(flat)
    total = spark.read.parquet(f"{path}/bounds").count()
    day, state = (dt.date(2016, 6, 5),) * 2, ("S07", "S07")
    ids = (500, 900)
    cases = [{"day": day}, {"state": state}, {"id": ids}, {"day": day, "state": state}, {"day": day, "state": state, "id": ids}]
    opened = []
    for where in cases:
        want = table
        for c, (low, high) in where.items():
            want = want.where(F.col(c).between(F.lit(low), F.lit(high)))
        got = read_z_ordered(spark, path, table.schema, where)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        opened.append(len(files_for(spark, path, where)))
    assert total > FILES // 2
    assert all(n <= total * 0.6 for n in opened[:3])               # one column of three
    assert opened[3] <= total * 0.25 and opened[4] <= total * 0.1  # two and three columns
    months = spark.read.parquet(flat).where(F.col("state") == "S07").select(F.input_file_name()).distinct().count()
    assert months == 12                                            # the partitioned table opens every file for a state


def test_nulls_one_value_and_empty_tables(spark):
    schema = "a long, b string"
    rows = [(None, "x"), (1, None), (1, "x"), (1, "é"), (5, "x")] * 20
    path = scratch_path(spark, "z-small")
    write_z_ordered(spark.createDataFrame(rows, schema), path, ["a", "b"], 4)
    got = read_z_ordered(spark, path, spark.createDataFrame([], schema).schema, {"a": (1, 1)})
    assert got.count() == 60 and read_z_ordered(spark, path, got.schema, {"a": (7, 9)}).count() == 0
    empty = scratch_path(spark, "z-empty")
    write_z_ordered(spark.createDataFrame([], schema), empty, ["a", "b"], 4)
    assert read_z_ordered(spark, empty, got.schema, {"a": (0, 9)}).count() == 0


def test_z_values_keep_neighbours_together(spark):
    df = spark.range(256).select((F.col("id") % 16).alias("a"), F.floor(F.col("id") / 16).alias("b"))
    z = df.select("a", "b", z_value(df, ["a", "b"], 4).alias("z")).collect()
    assert len({r.z for r in z}) >= 200
    first = sorted(z, key=lambda r: r.z)[:49]                      # a quarter: a box, not a stripe
    assert max(r.a for r in first) <= 8 and max(r.b for r in first) <= 8


def test_places_are_found_by_halving_and_numbers_made_once(spark):
    for n in (0, 1, 2, 7, 8, 1023):
        borders = [3.0 * i - 5 for i in range(n)]
        x = [None, -1e9, 1e9, -5.0, -4.5, *[b + d for b in borders[:40] + borders[-3:] for d in (-0.5, 0.0, 0.5)]]
        df = spark.createDataFrame([(v,) for v in x], "x double")
        got = df.select("x", _place(F.col("x"), borders).alias("at")).collect()
        assert [r.at for r in got] == [0 if r.x is None else bisect.bisect_right(borders, r.x) for r in got]
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        calls.add(1)
        return v

    spark.range(10).select(_place(seen(F.col("id").cast("double")), [float(i) for i in range(500)])).collect()
    assert calls.value == 10
