import pytest
from pyspark.sql import functions as F

from portstar.session import scratch_path
from portstar.sources import read_arrivals, read_demographics, write_csv
from portstar.sources.schemas import ARRIVAL_SOURCE_COLUMNS, ARRIVALS_SCHEMA, DEMOGRAPHICS_SCHEMA


def test_read_arrivals_from_any_format_keeps_the_13_columns_with_sas_types(spark):
    path = scratch_path(spark, "test-arrivals-parquet")
    wide = spark.range(3).select(
        *[(F.col("id") + 1).cast("int" if name in ("cicid", "arrdate") else "double").alias(name)
          if ARRIVALS_SCHEMA[name].dataType.simpleString() == "double" else F.lit("x").alias(name)
          for name in ARRIVAL_SOURCE_COLUMNS],
        F.lit("extra").alias("entdepa"))
    wide.write.parquet(path)
    df = read_arrivals(spark, path, fmt="parquet")
    assert df.columns == ARRIVAL_SOURCE_COLUMNS
    assert [f.dataType for f in df.schema] == [f.dataType for f in ARRIVALS_SCHEMA]
    narrow = _without_column(spark, wide, "fltno")
    with pytest.raises(ValueError):
        read_arrivals(spark, narrow, fmt="parquet")


def _without_column(spark, df, column):
    path = scratch_path(spark, "test-arrivals-narrow")
    df.drop(column).write.parquet(path)
    return path


def test_read_demographics_explicit_and_inferred(spark):
    rows = [("Town", "State", 35.5, 10, 11, 21, 1, 2, 2.5, "CA", "Asian", 5),
            ("City", "State", None, None, 11, 11, None, 2, None, "CA", "Other", 7)]
    src = spark.createDataFrame(rows, DEMOGRAPHICS_SCHEMA)
    path = write_csv(src, scratch_path(spark, "test-demo-csv"), sep=";")
    explicit = read_demographics(spark, path)
    assert explicit.schema == DEMOGRAPHICS_SCHEMA
    assert sorted(explicit.collect()) == sorted(src.collect())
    inferred = read_demographics(spark, path, infer_schema=True)
    types = dict(inferred.dtypes)
    assert types["Median Age"] == "double" and types["Count"] == "int"


def test_wide_reordered_csv_is_read_by_name_and_bad_rows_are_listed(spark, tmp_path):
    import pytest

    from portstar.sources.readers import read_arrivals, read_demographics, rejected_arrivals

    path = str(tmp_path / "wide.csv")
    with open(path, "w") as f:
        f.write("idx,gender,fltno,airline,i94yr,biryear,occup,i94visa,depdate,i94addr,arrdate,i94port,i94res,i94cit,cicid\n"
                "0,F,100,AA,2016.0,1980,,1.0,20550.0,CA,20545.0,NYC,582.0,209.0,7.0\n"
                "1,M,200,BA,2016.0,1O80,,1.0,,CA,20545.0,NYC,582.0,209.0,8.0\n")
    rows = read_arrivals(spark, path, fmt="csv").collect()
    assert [(r.cicid, r.gender, r.fltno, r.arrdate, r.i94addr) for r in rows] == [(7.0, "F", "100", 20545.0, "CA")]
    bad = rejected_arrivals(spark, path).collect()
    assert [(r.cicid, r.biryear, r.bad_columns) for r in bad] == [("8.0", "1O80", ["biryear"])]
    with open(path, "w") as f:
        f.write("cicid,gender\n1.0,F\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_arrivals(spark, path, fmt="csv")
    with pytest.raises(ValueError, match="lacks columns"):
        read_demographics(spark, path)


def test_malformed_ids_stay_apart(spark):
    from portstar.plans.staging import rejected_trips, stage_trips
    from portstar.sources.schemas import ARRIVALS_SCHEMA

    row = lambda i, d=20545.0: (i, 209.0, 582.0, "NYC", d, "CA", None, 1.0, None, 1980.0, "F", "AA", "1")
    df = spark.createDataFrame([row(1.0), row(1.5), row(2.5), row(3.0, 2_936_550.0), row(4.0, -715_509.0),
                                row(None)], ARRIVALS_SCHEMA)
    staged = stage_trips(df).collect()
    assert sorted((r.cic_id or 0, str(r.arrive_date)) for r in staged) == [
        (0, "2016-04-01"), (1, "2016-04-01"), (4, "0001-01-01")]
    assert sorted((r.cicid, r.bad_columns) for r in rejected_trips(df).collect()) == [
        (1.5, "cicid"), (2.5, "cicid"), (3.0, "arrdate")]


def test_reopened_warehouse_keeps_its_types(spark):
    from portstar.plans.warehouse import Warehouse
    from portstar.session import scratch_path

    root = scratch_path(spark, "reopened")
    house = Warehouse(spark, root)
    house.write("stage_immigration", spark.createDataFrame([(1, "07")], "cic_id long, state_code string"))
    again = Warehouse(spark, root).table("stage_immigration")
    assert [tuple(r) for r in again.collect()] == [(1, "07")]
