"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query starts from the driver's test tables through the stand-in raw inputs
(``sources.testdata``), so its work grows with the tables. Averages are rounded to 4 places in
the outputs, as in the SQL oracle, because summation order differs between engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portstar.functions.dates import (
    calendar_columns,
    sas_day_number,
    sas_timestamp,
    with_sas_dates,
)
from portstar.operators.columns import drop_sparse_columns
from portstar.operators.profile import (
    missing_profile,
    missing_profile_wide,
    null_check,
    null_counts,
    null_rows,
    null_rows_union,
)
from portstar.plans import dims
from portstar.plans.bi import busiest_arrival_days, daily_summary, population_by_state_month
from portstar.plans.contract import validate_contract
from portstar.plans.fact import (
    FACT_COLUMNS,
    STATE_COLUMNS,
    demographics_by_state,
    fact_trips,
    fact_trips_grouped,
    unmatched_states,
)
from portstar.plans.evolution import split_fitting
from portstar.plans.key_registry import register, with_ids
from portstar.plans.layout import read_z_ordered, write_z_ordered
from portstar.plans.maintenance import archive_split, incremental_load, write_bucketed
from portstar.plans.publish import contract_violations, publish_warehouse, write_tables
from portstar.plans.quality import duplicate_listing, key_report, merge_report, missing_value_rows
from portstar.plans.sketches import ERROR, key_sketches, sketch_report
from portstar.plans.snapshots import AuditFailed, SnapshotStore
from portstar.plans.statistics import column_statistics, merged, profile
from portstar.plans.staging import rejected_trips, stage_demographics, stage_trips
from portstar.plans.summaries import DAILY, Summary, averages, refresh, roll_up
from portstar.plans.warehouse import LAYOUT, Warehouse
from portstar.session import scratch_path
from portstar.sources.readers import (
    read_arrivals,
    read_demographics,
    read_table,
    read_testdata,
    rejected_arrivals,
)
from portstar.sources.schemas import ARRIVALS_SCHEMA
from portstar.sources.sinks import TableSpec, preview, write_csv, write_table
from portstar.sources.testdata import (
    arrivals_from_testdata,
    demographics_from_testdata,
    with_bad_cells,
)
from portstar.streaming.dedup import Deduplication, stream_deduplicated
from portstar.streaming.incremental import stream_arrivals_into_fact

Query = Callable[[SparkSession, str], DataFrame]

ROUND_DIGITS = 4
# Parameters of the example BI question ("trips and population in a given year and state"),
# of the incremental load (first load before 2000, then an increment re-sending December 1999)
# and of the archive split (months before 1998 are archived).
BI_YEAR, BI_STATE = 1998, "12"
FIRST_LOAD_BEFORE, INCREMENT_FROM = "2000-01-01", "1999-12-01"
ARCHIVE_BEFORE = (1998, 1)
FILES_PER_BATCH = 2  # landing files taken by one micro-batch
TOP_K = 20
# Deliveries of the deduplicated stream, and how far apart repeats are still found.
DELIVERIES = ("arrive_date < DATE'1997-01-01'",
              "arrive_date >= DATE'1996-07-01' AND arrive_date < DATE'1998-07-01'",
              "arrive_date >= DATE'1998-01-01' OR arrive_date < DATE'1995-01-01' AND cic_id % 10 = 3")
DELAY_DAYS = 365


def rounded(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Round every double column (averages) so engines with other summation orders agree."""
    return df.select([F.round(F.col(f.name), digits).alias(f.name)
                      if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                      for f in df.schema.fields])


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_trips(arrivals_from_testdata(spark, sf_dir))


def _demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_demographics(demographics_from_testdata(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_trips(_trips(spark, sf_dir), _demo(spark, sf_dir))


def _written_staging(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both staging tables written once and read back, for checks that build several tables
    from them (each table then reads Parquet instead of redoing the raw-input joins). Nothing
    reads these intermediates by state, so they are written unpartitioned (no extra shuffle)."""
    trips, demo = _trips(spark, sf_dir), _demo(spark, sf_dir)
    trips_path, demo_path = scratch_path(spark, "stage-trips"), scratch_path(spark, "stage-demo")
    write_table(trips, TableSpec("stage_immigration", trips_path))
    write_table(demo, TableSpec("stage_demographics", demo_path))
    return read_table(spark, trips_path, trips.schema), read_table(spark, demo_path, demo.schema)


def _written_fact(spark: SparkSession, sf_dir: str,
                  partition_by: tuple[str, ...] = ("year", "month")) -> tuple[str, DataFrame]:
    """The fact written partitioned by year and month, read back with its schema. Where nothing reads it by
    month, ``partition_by`` is empty: rows are then written where they were made distinct, without a shuffle."""
    fact = fact_trips(_trips(spark, sf_dir), _demo(spark, sf_dir), deal_by=partition_by)
    path = scratch_path(spark, "fact")
    write_table(fact, TableSpec("immi_demographics", path, partition_by, dealt=True))
    return path, read_table(spark, path, fact.schema)


# --- staging and profiles -------------------------------------------------------------------

def q_stage_trips(spark, sf_dir):
    return _trips(spark, sf_dir)


def q_stage_demographics(spark, sf_dir):
    return _demo(spark, sf_dir)


def q_stage_rejects(spark, sf_dir):
    return rejected_trips(with_bad_cells(arrivals_from_testdata(spark, sf_dir)))


def q_sas_dates_in_place(spark, sf_dir):
    arrivals = arrivals_from_testdata(spark, sf_dir)
    return with_sas_dates(arrivals, ["arrdate", "depdate"]).select("cicid", "fltno", "arrdate", "depdate")


def q_staging_balance(spark, sf_dir):
    """Input rows against distinct staged rows, their repeats and rejects."""
    path = scratch_path(spark, "arrivals-bad")
    with_bad_cells(arrivals_from_testdata(spark, sf_dir)).write.parquet(path)
    arrivals = read_arrivals(spark, path)
    good = arrivals.join(rejected_trips(arrivals).select("cicid", "depdate").distinct().withColumnsRenamed(
        {"cicid": "c", "depdate": "d"}), F.col("cicid").eqNullSafe(F.col("c"))
        & F.col("depdate").eqNullSafe(F.col("d")), "left_anti")
    parts = [arrivals.select(F.lit("input").alias("part")), good.select(F.lit("accepted").alias("part")),
             stage_trips(arrivals).select(F.lit("staged").alias("part")),
             rejected_trips(arrivals).select(F.lit("rejected").alias("part"))]
    rows = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def q_null_profile_trips(spark, sf_dir):
    return missing_profile(_trips(spark, sf_dir))


def q_null_profile_demographics(spark, sf_dir):
    return missing_profile(_demo(spark, sf_dir))


def q_null_profile_wide_trips(spark, sf_dir):
    return missing_profile_wide(_trips(spark, sf_dir))


def q_drop_sparse(spark, sf_dir):
    trips, _ = _written_staging(spark, sf_dir)      # profiled once, then read again
    return drop_sparse_columns(trips, max_missing_pct=90.0)


# --- dimensions -----------------------------------------------------------------------------

def q_dim_person(spark, sf_dir):
    return dims.dim_person(_trips(spark, sf_dir))


def q_dim_airline(spark, sf_dir):
    return dims.dim_airline(_trips(spark, sf_dir))


def q_dim_arrive_calendar(spark, sf_dir):
    return dims.dim_arrive_calendar(_trips(spark, sf_dir))


def q_dim_depart_calendar(spark, sf_dir):
    return dims.dim_depart_calendar(_trips(spark, sf_dir))


def q_week_iso_calendar(spark, sf_dir):
    return dims.iso_week_calendar(_trips(spark, sf_dir))


def q_dim_population(spark, sf_dir):
    return dims.dim_population(_demo(spark, sf_dir))


# --- fact and BI ----------------------------------------------------------------------------

def q_demographics_by_state(spark, sf_dir):
    return rounded(demographics_by_state(_demo(spark, sf_dir)))


def q_demographics_by_state_per_city(spark, sf_dir):
    return rounded(demographics_by_state(_demo(spark, sf_dir), per_city=True))


def q_fact_trips(spark, sf_dir):
    return rounded(_fact(spark, sf_dir))


def q_fact_trips_grouped(spark, sf_dir):
    return rounded(fact_trips_grouped(_trips(spark, sf_dir), _demo(spark, sf_dir)))


def q_fact_unmatched_states(spark, sf_dir):
    return unmatched_states(_trips(spark, sf_dir), _demo(spark, sf_dir))


def q_bi_population_by_state_month(spark, sf_dir):
    return rounded(population_by_state_month(_fact(spark, sf_dir)))


def q_bi_population_year_state(spark, sf_dir):
    _, fact = _written_fact(spark, sf_dir)
    return rounded(population_by_state_month(fact, year=BI_YEAR, state=BI_STATE))


def q_preview_top(spark, sf_dir):
    return busiest_arrival_days(_fact(spark, sf_dir), TOP_K)


# --- quality --------------------------------------------------------------------------------

def q_key_report(spark, sf_dir):
    trips, demo = _written_staging(spark, sf_dir)
    return key_report({
        "dim_immi_personel": (dims.dim_person(trips), "cic_id"),
        "dim_immi_airline": (dims.dim_airline(trips), "travel_id"),
        "dim_arrive_calendar": (dims.dim_arrive_calendar(trips), "arrive_date"),
        "dim_depart_calendar": (dims.dim_depart_calendar(trips), "depart_date"),
        "demo_population_dim": (dims.dim_population(demo), "demo_pop_id"),
        # not keys: trips repeat home countries, and some have no port
        "stage_trips_by_country": (trips, "country_code_1"),
        "stage_trips_by_port": (trips, "city_code"),
    })


def q_merge_report(spark, sf_dir):
    return merge_report(_trips(spark, sf_dir), _demo(spark, sf_dir))


def q_duplicate_cic_ids(spark, sf_dir):
    return duplicate_listing(_trips(spark, sf_dir), ["cic_id"])


def q_duplicate_dates(spark, sf_dir):
    return duplicate_listing(_trips(spark, sf_dir).select("depart_date"), ["depart_date"])


def q_missing_dates(spark, sf_dir):
    return missing_value_rows(_trips(spark, sf_dir), "depart_date")


def q_null_rows_union(spark, sf_dir):
    return null_rows_union(dims.dim_person(_trips(spark, sf_dir)), dims.PERSON_COLUMNS)


def q_null_rows_single_scan(spark, sf_dir):
    return null_rows(dims.dim_person(_trips(spark, sf_dir)), dims.PERSON_COLUMNS)


def q_null_rows_one_pass(spark, sf_dir):
    return null_counts(dims.dim_person(_trips(spark, sf_dir)), dims.PERSON_COLUMNS)


def q_null_check_verdict(spark, sf_dir):
    return null_check(dims.dim_person(_trips(spark, sf_dir)), dims.PERSON_COLUMNS)


def q_schema_contract(spark, sf_dir):
    trips, demo = _written_staging(spark, sf_dir)
    return validate_contract(spark, {
        "dim_immi_personel": dims.dim_person(trips),
        "dim_immi_airline": dims.dim_airline(trips),
        "dim_arrive_calendar": dims.dim_arrive_calendar(trips),
        "dim_depart_calendar": dims.dim_depart_calendar(trips),
        "demo_population_dim": dims.dim_population(demo),
        "immi_demographics": fact_trips(trips, demo),
    })


# --- sources and sinks ----------------------------------------------------------------------

def q_parquet_roundtrip_partitioned(spark, sf_dir):
    trips = _trips(spark, sf_dir)
    path = scratch_path(spark, "stage_immigration")
    write_table(trips, TableSpec("stage_immigration", path, ("state_code",)))
    return read_table(spark, path, trips.schema)


def q_csv_roundtrip(spark, sf_dir):
    path = write_csv(demographics_from_testdata(spark, sf_dir), scratch_path(spark, "demo-csv"), sep=";")
    return stage_demographics(read_demographics(spark, path, sep=";"))


def q_csv_arrivals_roundtrip(spark, sf_dir):
    path = write_csv(arrivals_from_testdata(spark, sf_dir), scratch_path(spark, "arrivals-csv"))
    return stage_trips(read_arrivals(spark, path, fmt="csv"))


def _wide_csv(spark, sf_dir) -> str:
    """An arrivals file as agencies send it: other columns around the 13, in another order, and
    letters in the id of every 6th line."""
    a = arrivals_from_testdata(spark, sf_dir)
    bad = F.when(F.col("cicid") % 10 == 6, F.concat(F.col("cicid").cast("bigint").cast("string"), F.lit("x")))
    wide = a.select(
        F.lit("0").alias("index"), "fltno", "airline", F.lit(2016.0).alias("i94yr"), "gender", "biryear",
        F.lit("G").alias("entdepa"), "occup", "i94visa", "depdate", "i94addr", F.lit(4.0).alias("i94mon"),
        "arrdate", "i94port", "i94res", "i94cit", F.lit(None).cast("string").alias("insnum"),
        F.coalesce(bad, F.col("cicid").cast("string")).alias("cicid"))
    return write_csv(wide, scratch_path(spark, "arrivals-wide-csv"))


def q_csv_wide_arrivals(spark, sf_dir):
    return stage_trips(read_arrivals(spark, _wide_csv(spark, sf_dir), fmt="csv"))


def q_csv_rejects(spark, sf_dir):
    return rejected_arrivals(spark, _wide_csv(spark, sf_dir)).select(
        "cicid", "i94port", "fltno", F.array_join("bad_columns", ",").alias("bad_columns"))


def q_csv_malformed_lines(spark, sf_dir):
    """Lines of an arrivals file that break off early (every 11th) or go on too long (every 13th), and
    the number of lines that are read."""
    a = arrivals_from_testdata(spark, sf_dir)
    key, names = F.col("cicid").cast("bigint"), [f.name for f in ARRIVALS_SCHEMA.fields]
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    line = (F.when(key % 11 == 0, F.concat_ws(",", *cells[:5])).when(key % 13 == 0, F.concat_ws(",", *cells, F.lit("x"), F.lit("y")))
            .otherwise(F.concat_ws(",", *cells)))
    # one column whose name and values are whole lines; the separator does not occur in them
    path = write_csv(a.select(line.alias(",".join(names))), scratch_path(spark, "malformed-csv"), sep="\u0001")
    bad = rejected_arrivals(spark, path).select(
        F.split("line", ",")[0].cast("double").cast("bigint").alias("cic_id"),
        F.size(F.split("line", ",")).alias("fields"), F.array_join("bad_columns", ",").alias("bad_columns"))
    good = read_arrivals(spark, path, fmt="csv").select(
        F.lit(None).cast("bigint").alias("cic_id"), F.lit(len(names)).alias("fields"), F.lit("").alias("bad_columns"))
    return bad.unionAll(good).groupBy("cic_id", "fields", "bad_columns").agg(F.count(F.lit(1)).alias("n"))


def _built_warehouse(spark, sf_dir) -> Warehouse:
    """The whole warehouse, opened again by another object, as a later process does."""
    root = scratch_path(spark, "warehouse")
    Warehouse(spark, root).build(arrivals_from_testdata(spark, sf_dir),
                                 demographics_from_testdata(spark, sf_dir))
    return Warehouse(spark, root)


def q_warehouse_build(spark, sf_dir):
    house = _built_warehouse(spark, sf_dir)
    return rounded(house.table("immi_demographics"))


def q_sql_quality_checks(spark, sf_dir):
    """Row, key and null counts in SQL over views of the written tables."""
    tag = f"w{uuid.uuid4().hex[:12]}_"
    _built_warehouse(spark, sf_dir).register_views(tag)
    parts = [f"SELECT '{table}' AS table_name, count(*) AS total_rows, count({key}) AS non_null_keys, "
             f"count(DISTINCT {key}) AS distinct_keys FROM {tag}{table}"
             for table, key in (("dim_immi_personel", "cic_id"), ("dim_immi_airline", "travel_id"),
                                ("dim_arrive_calendar", "arrive_date"), ("dim_depart_calendar", "depart_date"),
                                ("demo_population_dim", "demo_pop_id"), ("stage_immigration", "state_code"),
                                ("immi_demographics", "cic_id"))]
    return spark.sql(" UNION ALL ".join(parts))


# --- maintenance ----------------------------------------------------------------------------

def _two_loads(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A first load with open departures, old cities and wrong arrival dates; then an increment
    that corrects some of those rows (a moved date changes the partition), brings new rows, and
    holds an outdated version of some. The first by ``load_order`` of each ``cic_id`` counts."""
    key, arrived = F.col("cic_id"), F.col("arrive_date")

    def version(df, n):
        return df.withColumns({"year": F.year("arrive_date"), "month": F.month("arrive_date"),
                               "load_order": F.lit(n)})

    wrong = fact.withColumns({
        "city_code": F.when(key % 5 == 0, F.lit("OLD")).otherwise(F.col("city_code")),
        "depart_date": F.when(key % 3 == 0, F.lit(None).cast("date")).otherwise(F.col("depart_date")),
        "arrive_date": F.when(key % 7 == 0, F.date_sub(arrived, 60)).otherwise(arrived)})
    first = version(wrong.where(arrived < F.lit(FIRST_LOAD_BEFORE).cast("date")), 2)
    twice = first.unionByName(version(fact.where(
        (arrived < F.lit(FIRST_LOAD_BEFORE).cast("date")) & (key % 13 == 0)), 1))     # corrected in the load
    sent = fact.where((arrived >= F.lit(INCREMENT_FROM).cast("date")) | (key % 35 < 8))
    later = version(sent, 1).unionByName(version(sent.where(key % 11 == 0).withColumn("city_code", F.lit("???")), 2))
    return twice, later


LOAD_ORDER = ["load_order"]


def q_incremental_upsert(spark, sf_dir):
    """Both loads merged into plain Parquet: the last version of each ``cic_id`` has to remain."""
    path = scratch_path(spark, "fact-incremental")
    _, fact = _written_fact(spark, sf_dir, ())
    for part in _two_loads(fact):
        incremental_load(spark, path, part, ["cic_id"], ("year", "month"), LOAD_ORDER, drop=LOAD_ORDER)
    return rounded(read_table(spark, path, part.drop(*LOAD_ORDER).schema))


# --- versioned tables -----------------------------------------------------------------------

FACT_TABLE = "immi_demographics"


def _loaded_store(spark, sf_dir, *summaries: Summary) -> SnapshotStore:
    """The two loads as two versions of a store, with summaries maintained by each. The fact's state columns
    follow from the state, so that they go beside the loads' rows: repeats are told by the trip columns."""
    store = SnapshotStore(spark, scratch_path(spark, "snapshots"))
    _, fact = _written_fact(spark, sf_dir, ())
    states = fact.select("immigration_state_code", *STATE_COLUMNS).distinct()
    for note, part in zip(("first", "increment"), _two_loads(fact)):
        load = store.begin(note)
        load.merge(FACT_TABLE, part.drop(*STATE_COLUMNS), ["cic_id"], LOAD_ORDER, LOAD_ORDER,
                   partition_by=("year", "month"), side=states, side_keys=["immigration_state_code"])
        for summary in summaries:
            refresh(load, summary)
        load.commit()
    return store


def q_snapshot_merge_on_read(spark, sf_dir):
    return rounded(_loaded_store(spark, sf_dir).table(FACT_TABLE))


def q_snapshot_compacted(spark, sf_dir):
    """The same after compaction, with the old versions and their files gone."""
    store = _loaded_store(spark, sf_dir)
    store.compact(FACT_TABLE)
    store.expire(keep=1)
    return rounded(store.table(FACT_TABLE))


def q_snapshot_time_travel(spark, sf_dir):
    """The first version, read after the second was published and compacted."""
    store = _loaded_store(spark, sf_dir)
    store.compact(FACT_TABLE)
    return rounded(store.table(FACT_TABLE, version=1))


def q_snapshot_changes(spark, sf_dir):
    """Rows that the increment added and took away, by month."""
    changes = _loaded_store(spark, sf_dir).changes(FACT_TABLE, since=1)
    return changes.groupBy("change", "year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cic_id").alias("travellers"))


def q_summary_upkeep(spark, sf_dir):
    """The daily summary after both loads, kept by additions and retractions."""
    store = _loaded_store(spark, sf_dir, DAILY)
    return rounded(averages(store.table(DAILY.name), DAILY).withColumnRenamed(
        "avg_Total_Population", "avg_population"))


def q_summary_roll_up(spark, sf_dir):
    """Months and states from the kept daily state, without the fact."""
    store = _loaded_store(spark, sf_dir, DAILY)
    groups = ("year", "month", "immigration_state_code")
    monthly = replace(DAILY, groups=groups)
    return rounded(averages(roll_up(store.table(DAILY.name), DAILY, groups), monthly).withColumnRenamed(
        "avg_Total_Population", "avg_population"))


def q_key_registry(spark, sf_dir):
    """Ids of flights over two loads: the second load's trips, counted by the id of their flight."""
    trips, _ = _written_staging(spark, sf_dir)
    store = SnapshotStore(spark, scratch_path(spark, "registry"))
    before = F.col("arrive_date") < F.lit(FIRST_LOAD_BEFORE).cast("date")
    for part in (trips.where(before), trips):
        load = store.begin()
        register(load, "flight_ids", part, dims.AIRLINE_COLUMNS, "flight_id")
        load.commit()
    found = with_ids(trips.select(*dims.AIRLINE_COLUMNS), store.table("flight_ids"), dims.AIRLINE_COLUMNS, "flight_id")
    return found.groupBy("flight_id", *dims.AIRLINE_COLUMNS).agg(F.count(F.lit(1)).alias("trips"))


def q_published_warehouse(spark, sf_dir):
    """A good build; then one that breaks the contract (arrival days missing from the calendar) and
    stays invisible. What readers see, and what the audit found."""
    store = SnapshotStore(spark, scratch_path(spark, "published"))
    arrivals, demo = arrivals_from_testdata(spark, sf_dir), demographics_from_testdata(spark, sf_dir)
    publish_warehouse(store, arrivals, demo)
    load = store.begin("bad")
    write_tables(load, arrivals, demo)
    load.replace("dim_arrive_calendar", load.table("dim_arrive_calendar").withColumn(
        "arrive_date", F.when(F.col("day") != 1, F.col("arrive_date"))), LAYOUT["dim_arrive_calendar"])
    found = None
    try:
        load.commit(contract_violations)
    except AuditFailed as refused:
        found = refused.report
    parts = [store.table(t).select(F.lit("visible").alias("kind"), F.lit(t).alias("name")).groupBy("kind", "name")
             .agg(F.count(F.lit(1)).alias("n")) for t in LAYOUT]
    parts.append(found.select(F.lit("finding").alias("kind"), F.concat_ws(".", "table_name", "field", "rule").alias("name"),
                              F.col("violations").alias("n")))
    return reduce(DataFrame.unionAll, parts)


def _cities_in_two_shapes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Cities as an early increment brings them, and as a later one does: with millionths of
    a person (a wider type) and one more column."""
    demo = _demo(spark, sf_dir)
    early = F.col("Race") < "F"
    columns = ["State_Code", "City", "Race", "Total_Population"]
    later = demo.where(~early | early.isNull()).withColumn(
        "Total_Population", F.col("Total_Population").cast("long") * 1_000_000)
    return demo.where(early).select(*columns), later.select(*columns, "Foreign_born")


def q_schema_evolution(spark, sf_dir):
    early, later = _cities_in_two_shapes(spark, sf_dir)
    store = SnapshotStore(spark, scratch_path(spark, "evolving"))
    load = store.begin()
    load.replace("cities", early, ("State_Code",))
    load.commit()
    load = store.begin()
    load.append("cities", later)
    load.commit()
    return store.table("cities")


def q_schema_refusals(spark, sf_dir):
    """Rows of the later increment that a table of the early types cannot hold."""
    early, later = _cities_in_two_shapes(spark, sf_dir)
    return split_fitting(later.drop("Foreign_born"), early.schema)[1].withColumn(
        "bad_columns", F.array_join("bad_columns", ","))


def q_key_sketch_report(spark, sf_dir):
    """Distinct travellers and airlines by year from stored monthly sketches, with whether the
    estimate is within four standard errors of the exact count."""
    _, fact = _written_fact(spark, sf_dir)
    keys, path = ["cic_id", "flight_number"], scratch_path(spark, "sketches")
    key_sketches(fact, FACT_TABLE, keys, ["year", "month"]).write.parquet(path)
    report = sketch_report(spark.read.parquet(path), ["year"])
    exact = fact.groupBy("year").agg(*[F.count_distinct(k).alias(k) for k in keys]).unpivot(
        ["year"], keys, "key_name", "exact")
    near = F.abs(F.col("distinct_keys") - F.col("exact")) <= 4 * ERROR * F.col("exact")
    return report.join(exact, ["year", "key_name"]).select(
        "table_name", "key_name", "year", "total_rows", "null_keys", near.alias("within_bound"))


def q_column_statistics(spark, sf_dir):
    """Profile of each year from stored monthly statistics: counts and bounds, without a second scan."""
    _, fact = _written_fact(spark, sf_dir)
    path = scratch_path(spark, "statistics")
    column_statistics(fact, ["year", "month"], ["gender", "city_code", "birth_year", "depart_date"]).write.parquet(path)
    yearly = profile(merged(spark.read.parquet(path), ["year"]))
    return yearly.select("year", "column_name", "total_rows", "missing", "low", "high")


def q_write_status(spark, sf_dir):
    """Status of guarded writes that count their rows as they pass."""
    trips, demo = _written_staging(spark, sf_dir)
    results = [write_table(df, TableSpec(name, scratch_path(spark, name), parts), count_rows=True)
               for name, df, parts in (("dim_immi_personel", dims.dim_person(trips), ()),
                                       ("dim_depart_calendar", dims.dim_depart_calendar(trips), ("year", "month")),
                                       ("demo_population_dim", dims.dim_population(demo), ()))]
    return spark.createDataFrame([(r.table, r.rows, r.ok) for r in results], "table_name string, n long, ok boolean")


def q_preview_rows(spark, sf_dir):
    """The first rows of a sorted calendar, brought to the driver and shown from there."""
    trips = _trips(spark, sf_dir)
    calendar = dims.dim_arrive_calendar(trips)
    return spark.createDataFrame(preview(calendar.orderBy("arrive_date"), TOP_K), calendar.schema)


def q_archive_split(spark, sf_dir):
    path, fact = _written_fact(spark, sf_dir)
    archive, live = scratch_path(spark, "archive"), scratch_path(spark, "live")
    archive_split(spark, path, archive, live, fact.schema, *ARCHIVE_BEFORE)
    parts = [read_table(spark, p, fact.schema).withColumn("part", F.lit(name))
             for name, p in (("archive", archive), ("live", live))]
    return rounded(parts[0].unionByName(parts[1]))


def q_bucketed_join(spark, sf_dir):
    trips, demo = _trips(spark, sf_dir), _demo(spark, sf_dir)
    tag = uuid.uuid4().hex[:12]
    # bucket count follows the cluster's shuffle width, so each bucket stays a task-sized slice
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fact = write_bucketed(fact_trips(trips, demo), f"fact_b_{tag}",
                          scratch_path(spark, "fact-bucketed"), "cic_id", buckets)
    person = write_bucketed(dims.dim_person(trips), f"person_b_{tag}",
                            scratch_path(spark, "person-bucketed"), "cic_id", buckets)
    # the merge hint keeps the layout in use where one side happens to be small
    joined = fact.join(person.select("cic_id", F.col("country_code_1").alias("home_country"))
                       .hint("merge"), "cic_id")
    return joined.groupBy("home_country").agg(F.count(F.lit(1)).alias("trips"),
                                              F.count_distinct("cic_id").alias("travellers"))


def q_z_ordered_lookup(spark, sf_dir):
    """A year of one state from the fact laid out along a Z curve of arrival day, state and traveller."""
    _, fact = _written_fact(spark, sf_dir, ())
    path = scratch_path(spark, "fact-z")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_z_ordered(fact, path, ["arrive_date", "immigration_state_code", "cic_id"], files)
    days = dt.date(BI_YEAR, 1, 1), dt.date(BI_YEAR, 12, 31)
    return rounded(read_z_ordered(spark, path, fact.schema, {
        "arrive_date": days, "immigration_state_code": (BI_STATE, BI_STATE)}))


def q_daily_summary(spark, sf_dir):
    summary = daily_summary(_fact(spark, sf_dir))
    path = scratch_path(spark, "daily-summary")
    write_table(summary, TableSpec("daily_summary", path, ("year", "month")))
    return rounded(read_table(spark, path, summary.schema))


def q_event_calendar(spark, sf_dir):
    events = read_testdata(spark, sf_dir, "events").select("ts")
    back = events.select(sas_timestamp(sas_day_number(F.col("ts"))).alias("event_ts"))
    days = back.select(F.col("event_ts").cast("date").alias("event_date"))
    per_day = days.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))
    return per_day.select("event_date", *calendar_columns("event_date"), "events")


def q_streamed_fact(spark, sf_dir):
    source = scratch_path(spark, "arrivals-drop")
    # the landing folder: as many files as the data needs, one for each partition of the join
    arrivals_from_testdata(spark, sf_dir).write.parquet(source)
    target = scratch_path(spark, "fact-streamed")
    demo = _demo(spark, sf_dir)
    stream_arrivals_into_fact(spark, source, target, demographics_by_state(demo),
                              files_per_batch=FILES_PER_BATCH)
    return rounded(read_table(spark, target).select(*FACT_COLUMNS))


def q_streamed_dedup(spark, sf_dir):
    """Three deliveries to a stream that is restarted between them: each repeats half a year of the one
    before, and the last brings some rows of years that are over. What was kept, and what came late."""
    trips, _ = _written_staging(spark, sf_dir)
    trips = trips.select("cic_id", "arrive_date", "flight_number").where(F.col("arrive_date").isNotNull())
    source, checkpoint = scratch_path(spark, "deliveries"), scratch_path(spark, "dedup-checkpoint")
    store = SnapshotStore(spark, scratch_path(spark, "deduplicated"))
    rule = Deduplication("trips", "late_trips", ("cic_id",), "arrive_date", DELAY_DAYS)
    for part in DELIVERIES:
        trips.where(part).write.mode("append").parquet(source)
        stream_deduplicated(spark, source, store, rule, trips.schema, checkpoint)
    kept = store.table("trips").select(F.lit("kept").alias("part"), *trips.columns)
    return kept.unionAll(store.table("late_trips").select("reason", *trips.columns))


QUERIES: dict[str, Query] = {
    "stage_trips": q_stage_trips,
    "stage_demographics": q_stage_demographics,
    "stage_rejects": q_stage_rejects,
    "staging_balance": q_staging_balance,
    "sas_dates_in_place": q_sas_dates_in_place,
    "null_profile_trips": q_null_profile_trips,
    "null_profile_demographics": q_null_profile_demographics,
    "null_profile_wide_trips": q_null_profile_wide_trips,
    "drop_sparse": q_drop_sparse,
    "dim_person": q_dim_person,
    "dim_airline": q_dim_airline,
    "dim_arrive_calendar": q_dim_arrive_calendar,
    "dim_depart_calendar": q_dim_depart_calendar,
    "week_iso_calendar": q_week_iso_calendar,
    "dim_population": q_dim_population,
    "demographics_by_state": q_demographics_by_state,
    "demographics_by_state_per_city": q_demographics_by_state_per_city,
    "fact_trips": q_fact_trips,
    "fact_trips_grouped": q_fact_trips_grouped,
    "fact_unmatched_states": q_fact_unmatched_states,
    "bi_population_by_state_month": q_bi_population_by_state_month,
    "bi_population_year_state": q_bi_population_year_state,
    "preview_top": q_preview_top,
    "key_report": q_key_report,
    "merge_report": q_merge_report,
    "duplicate_cic_ids": q_duplicate_cic_ids,
    "duplicate_dates": q_duplicate_dates,
    "missing_dates": q_missing_dates,
    "null_rows_union": q_null_rows_union,
    "null_rows_single_scan": q_null_rows_single_scan,
    "null_rows_one_pass": q_null_rows_one_pass,
    "null_check_verdict": q_null_check_verdict,
    "schema_contract": q_schema_contract,
    "parquet_roundtrip_partitioned": q_parquet_roundtrip_partitioned,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_arrivals_roundtrip": q_csv_arrivals_roundtrip,
    "csv_wide_arrivals": q_csv_wide_arrivals,
    "csv_rejects": q_csv_rejects,
    "csv_malformed_lines": q_csv_malformed_lines,
    "warehouse_build": q_warehouse_build,
    "sql_quality_checks": q_sql_quality_checks,
    "incremental_upsert": q_incremental_upsert,
    "snapshot_merge_on_read": q_snapshot_merge_on_read,
    "snapshot_compacted": q_snapshot_compacted,
    "snapshot_time_travel": q_snapshot_time_travel,
    "snapshot_changes": q_snapshot_changes,
    "summary_upkeep": q_summary_upkeep,
    "summary_roll_up": q_summary_roll_up,
    "key_registry": q_key_registry,
    "published_warehouse": q_published_warehouse,
    "schema_evolution": q_schema_evolution,
    "schema_refusals": q_schema_refusals,
    "key_sketch_report": q_key_sketch_report,
    "column_statistics": q_column_statistics,
    "write_status": q_write_status,
    "preview_rows": q_preview_rows,
    "archive_split": q_archive_split,
    "bucketed_join": q_bucketed_join,
    "z_ordered_lookup": q_z_ordered_lookup,
    "daily_summary": q_daily_summary,
    "event_calendar": q_event_calendar,
    "streamed_fact": q_streamed_fact,
    "streamed_dedup": q_streamed_dedup,
}
