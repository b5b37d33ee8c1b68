"""Continuous fact loading with Structured Streaming.

New arrival files dropped in a folder are picked up by a file stream. Each micro-batch is staged and its
trips are kept in a folder of that batch beside the stream's checkpoint (in the shared checkpoint folder),
which records which files were taken. When every file is taken, the kept trips are joined to the per-state
averages (a small static table, broadcast) and merged into the partitioned fact with the same incremental
upsert as the batch path. Arrivals of one file fall into any month, so a merge for each batch would read
and rewrite the whole fact as many times as there are batches; one merge moves every row once. It is keyed
on every trip column (ids of arrivals may repeat), so a replay leaves the fact unchanged. A stream that
breaks leaves the fact as it was; started again with its checkpoint, it merges what it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portstar.plans.bi import daily_summary
from portstar.plans.fact import FACT_KEYS, TRIP_COLUMNS, fact_trips, state_side
from portstar.plans.maintenance import incremental_load, refresh_derived
from portstar.plans.staging import stage_trips
from portstar.session import delete_folders, scratch_path
from portstar.sources.readers import typed_text, with_corrupt_record
from portstar.sources.schemas import ARRIVALS_SCHEMA, STAGED_TRIPS_SCHEMA
from portstar.sources.sinks import TableSpec, write_table

BATCH = "batch"


def trip_batch_writer(pending_path: str, side: DataFrame):
    """foreachBatch function: stage one batch of raw arrivals and keep its trips of covered states in a
    folder of its own below ``pending_path``. A batch that is run again replaces its folder."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        trips = stage_trips(batch).join(side.select("demographics_state_code"),
                                        F.col("state_code") == F.col("demographics_state_code"), "left_semi")
        write_table(trips.select(*TRIP_COLUMNS), TableSpec("pending", f"{pending_path}/{BATCH}={batch_id:012d}"))

    return apply


def merge_pending(spark: SparkSession, pending_path: str, target_path: str, side: DataFrame,
                  summary_path: str | None = None) -> None:
    """Merge the trips of all pending batches into the fact in one load, so that each month is rewritten
    once, and refresh the daily summary for the months it touched. Running it again changes nothing."""
    batches = _folders(spark, pending_path)
    if not batches:
        return
    trips = spark.read.schema(T.StructType([STAGED_TRIPS_SCHEMA[c] for c in TRIP_COLUMNS])).parquet(
        *[f"{pending_path}/{b}" for b in batches])
    by = ("year", "month")
    rows = fact_trips(trips, None, side=side, deal_by=by)
    # the keys hold the arrival day, so a load reads and rewrites its own months only
    done = incremental_load(spark, target_path, rows, FACT_KEYS, by, keys_fix_partition=True, dealt=True)
    if summary_path is not None:
        refresh_derived(spark, target_path, rows.schema, summary_path, daily_summary, done.touched)
    delete_folders(spark, [f"{pending_path}/{b}" for b in batches])


def _folders(spark: SparkSession, path: str) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def stream_arrivals_into_fact(spark: SparkSession, source_dir: str, target_path: str,
                              by_state: DataFrame, checkpoint: str | None = None,
                              files_per_batch: int = 1, source_format: str = "parquet",
                              options: dict | None = None, summary_path: str | None = None):
    """Run the stream over every file now in ``source_dir`` (available-now trigger) and stop.

    ``options`` go to the file source (e.g. ``{"header": "true"}`` for CSV landing files);
    ``summary_path`` keeps a daily summary table current alongside the fact. CSV files are read by
    the header of the folder's first file; files with another header fail the batch.
    """
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    # The per-state averages are static for the stream's lifetime: computed, size-checked and
    # persisted once, not per batch (a long-running stream must not add a cached table per batch).
    static_side = by_state.persist()
    side = state_side(static_side)
    options, schema = dict(options or {}), ARRIVALS_SCHEMA
    if source_format == "csv":
        options = {"header": "true", "enforceSchema": "false", "columnPruning": "false", **options}
        schema = with_corrupt_record(spark.read.options(**options).csv(source_dir).schema)   # names only: all strings
    stream = (spark.readStream.schema(schema).format(source_format).options(**options)
              .option("maxFilesPerTrigger", files_per_batch).load(source_dir))
    if source_format == "csv":
        stream = typed_text(stream, ARRIVALS_SCHEMA)[0]
    try:
        pending = f"{checkpoint.rstrip('/')}-pending"
        query = (stream.writeStream.foreachBatch(trip_batch_writer(pending, side))
                 .option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        merge_pending(spark, pending, target_path, side, summary_path)
    finally:
        static_side.unpersist()
    return query
