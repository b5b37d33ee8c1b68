"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1), local[$BENCH_CPUS].

Each query runs once to warm up, then BENCH_RUNS times (default 3); the median is reported.
Queries execute through Spark's ``noop`` sink, so the whole plan runs on the executors but no
(the fact with and without the outer GROUP BY, one-pass vs per-column null checks, partition pruning vs an
unpartitioned copy). The heavy queries (writes, loads, streams) are timed once each, last.

Prints ONE JSON line: {"metric", "value", "unit", "queries", "comparisons", "sf", ...}. Items not
started within $BENCH_BUDGET_SEC (default 900) are skipped and listed in "skipped_over_budget".
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from portstar.functions.missing import is_missing  # noqa: E402
from portstar.operators.profile import missing_profile, null_counts, null_rows_union  # noqa: E402
from portstar.plans import dims  # noqa: E402
from portstar.plans.bi import population_by_state_month  # noqa: E402
from portstar.plans.fact import fact_trips, fact_trips_grouped  # noqa: E402
from portstar.plans.staging import stage_demographics, stage_trips  # noqa: E402
from portstar.plans.warehouse import Warehouse  # noqa: E402
from portstar.registry import QUERIES  # noqa: E402
from portstar.session import get_session, scratch_path  # noqa: E402
from portstar.sources import TableSpec, read_table, write_table  # noqa: E402
from portstar.sources.testdata import arrivals_from_testdata, demographics_from_testdata  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Wall-clock budget: items not started within it are skipped (and listed) so the JSON line is
# always printed; the headline queries come first.
BUDGET = float(os.environ.get("BENCH_BUDGET_SEC", "900"))

# The flagship is timed last: the first timed query of a run read ~50% slow in every run here
# (4.3 s in isolation, 6.5 s when first), an artefact of position, not of the query.
HEADLINE = [
    "stage_trips", "fact_trips", "dim_person", "dim_airline", "dim_arrive_calendar",
    "dim_population", "null_profile_trips", "key_report", "merge_report", "fact_unmatched_states",
    "null_rows_one_pass", "duplicate_cic_ids", "preview_top", "bi_population_by_state_month",
]

HEAVY = ["incremental_upsert", "streamed_fact", "archive_split", "bucketed_join", "schema_contract",
         "drop_sparse", "warehouse_build", "sql_quality_checks", "csv_wide_arrivals", "staging_balance",
         "snapshot_merge_on_read", "summary_upkeep", "key_registry", "z_ordered_lookup", "streamed_dedup"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(RUNS):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def main() -> None:
    started = time.perf_counter()
    skipped: list[str] = []

    def within_budget(item: str) -> bool:
        if time.perf_counter() - started < BUDGET:
            return True
        skipped.append(item)
        return False

    spark = get_session(f"local[{CPUS}]", app_name="portstar-bench",
                        shuffle_partitions=CPUS * 2,
                        extra={"spark.driver.memory": "16g"})
    # One untimed pass first: JIT, codegen caches and file metadata warm up before any timing.
    for name in ("stage_trips", "fact_trips", "dim_person", "bi_population_by_state_month"):
        run(QUERIES[name](spark, SF_DIR))
    queries: dict[str, float] = {}
    for name in HEADLINE:
        if within_budget(name):
            queries[name] = timed(lambda n=name: run(QUERIES[n](spark, SF_DIR)))

    arrivals = arrivals_from_testdata(spark, SF_DIR)
    demographics = demographics_from_testdata(spark, SF_DIR)
    trips, demo = stage_trips(arrivals), stage_demographics(demographics)
    pairs = {
        "fact_trips": lambda: run(fact_trips(trips, demo)),
        "fact_trips_grouped": lambda: run(fact_trips_grouped(trips, demo)),
        "null_profile_trips": lambda: run(missing_profile(trips)),
        "null_profile_per_column_jobs":
            lambda: [trips.where(is_missing(trips, c)).count() for c in trips.columns],
        "null_rows_one_pass": lambda: run(null_counts(dims.dim_person(trips), dims.PERSON_COLUMNS)),
        "null_rows_union": lambda: run(null_rows_union(dims.dim_person(trips), dims.PERSON_COLUMNS)),
        "dim_arrive_calendar": lambda: run(dims.dim_arrive_calendar(trips)),
    }
    comparisons: dict[str, float] = {}
    for name, fn in pairs.items():
        if within_budget(name):
            comparisons[name] = timed(fn)

    # Written layouts: the whole warehouse, and the fact partitioned vs unpartitioned.
    build_sec = None
    if within_budget("written_layouts"):
        t0 = time.perf_counter()
        wh = Warehouse(spark, scratch_path(spark, "bench-warehouse"))
        wh.build(arrivals, demographics)
        build_sec = round(time.perf_counter() - t0, 3)
        fact = wh.table("immi_demographics")
        flat_path = scratch_path(spark, "bench-fact-flat")
        write_table(fact, TableSpec("fact_flat", flat_path))
        flat = read_table(spark, flat_path, fact.schema)
        comparisons["bi_year_state_partitioned"] = timed(
            lambda: run(population_by_state_month(fact, year=1998, state="12")))
        comparisons["bi_year_state_unpartitioned"] = timed(
            lambda: run(population_by_state_month(flat, year=1998, state="12")))
        queries["bi_population_on_written_fact"] = timed(lambda: run(population_by_state_month(fact)))
        reports = wh.quality_reports()
        comparisons["quality_reports_on_written_tables"] = timed(
            lambda: [run(df) for df in reports.values()])

    heavy: dict[str, float] = {}
    for name in HEAVY:
        if within_budget(name):
            t0 = time.perf_counter()
            run(QUERIES[name](spark, SF_DIR))
            heavy[name] = round(time.perf_counter() - t0, 3)

    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "comparisons": comparisons,
        "heavy": heavy,
        "warehouse_build_sec": build_sec,
        "sf": os.path.basename(SF_DIR).replace("sf", ""),
        "cpus": CPUS,
        "runs": RUNS,
        "skipped_over_budget": skipped,
        "wall_sec": round(time.perf_counter() - started, 1),
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
