import datetime as dt
import math

from pyspark.sql import functions as F

from portstar.functions import (
    code_text,
    sas_date,
    sas_day_number,
    sas_timestamp,
    travel_key,
    week_iso,
    week_us,
    whole_number,
)


def test_sas_day_to_date_and_timestamp(spark):
    rows = [(0.0,), (20545.0,), (-1.0,), (-0.5,), (20545.5,), (None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "d double")
    out = df.select(sas_date("d").alias("day"), sas_timestamp("d").alias("ts")).collect()
    assert [r.day for r in out] == [
        dt.date(1960, 1, 1), dt.date(2016, 4, 1), dt.date(1959, 12, 31), dt.date(1959, 12, 31),
        dt.date(2016, 4, 1), None, None]
    assert out[4].ts == dt.datetime(2016, 4, 1, 12, 0)
    assert out[3].ts == dt.datetime(1959, 12, 31, 12, 0)
    assert out[0].ts == dt.datetime(1960, 1, 1)
    assert out[5].ts is None and out[6].ts is None


def test_sas_day_number_round_trip(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 678901),)], "ts timestamp_ntz")
    back = df.select(sas_timestamp(sas_day_number("ts")).alias("t")).first().t
    assert back == dt.datetime(2024, 1, 2, 3, 4, 5, 678901)


def test_us_and_iso_weeks(spark):
    days = [dt.date(2016, 1, 1), dt.date(2016, 12, 31), dt.date(2017, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select(week_us("d").alias("us"), week_iso("d").alias("iso")).collect()
    assert [r.us for r in out] == [1, 53, 1]
    assert [r.iso for r in out] == [53, 52, 52]


def test_week_us_matches_legacy_week_pattern(spark):
    """The legacy formatter's 'w' (Sunday start, week of 1 January = 1) over 2015-2018."""
    days = spark.sql("SELECT explode(sequence(date'2015-01-01', date'2018-12-31')) AS d")
    key = "spark.sql.legacy.timeParserPolicy"
    before = spark.conf.get(key)
    spark.conf.set(key, "LEGACY")
    try:
        rows = days.select(week_us("d").alias("ours"),
                           F.date_format("d", "w").cast("int").alias("legacy")).collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 1461
    assert all(r.ours == r.legacy for r in rows)


def test_whole_number_rejects_fractions_and_nan(spark):
    df = spark.createDataFrame([(209.0,), (1.5,), (float("nan"),), (None,), (1e300,)], "x double")
    out = df.select(whole_number("x").alias("n"), code_text("x").alias("t")).collect()
    assert [r.n for r in out] == [209, None, None, None, None]
    assert out[0].t == "209"


def test_travel_key_separator_prevents_collisions(spark):
    df = spark.createDataFrame([(1, "2A"), (12, "A"), (5, None)], "n long, city string")
    keys = [r.k for r in df.select(travel_key(F.col("n"), F.col("city")).alias("k")).collect()]
    assert keys == ["1-2A", "12-A", "5"]
    assert len(set(keys)) == 3


def test_no_python_udf_in_date_plan(spark):
    df = spark.createDataFrame([(20545.0,)], "d double").select(sas_date("d"), week_us(sas_date("d")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert not math.isnan(0.0)


def test_with_sas_dates_converts_in_place(spark):
    from portstar.functions import with_sas_dates
    from portstar.sources import preview

    df = spark.createDataFrame([(1, 20545.0, None)], "id int, arr double, dep double")
    out = with_sas_dates(df, ["arr", "dep"])
    assert out.columns == ["id", "arr", "dep"]
    assert dict(out.dtypes)["arr"] == "date"
    assert out.first().arr == dt.date(2016, 4, 1)
    assert len(preview(out, 1)) == 1
