"""Stream deduplication with a watermark: repeats across micro-batches go, late rows are listed.

The keyed state is a table of the versioned store (keys seen, by event day), not the stream's own
state, so that one published version moves everything together: the deduplicated rows, the rejects, the
state, the watermark and the number of the batch. A batch that is replayed after a failure finds its
number and changes nothing; a batch that dies has published nothing.

As in ``dropDuplicatesWithinWatermark``, the watermark is the latest event seen in earlier batches less
the delay; keys are forgotten when their event falls behind it, so the state holds the delay's worth of
keys whatever the stream's age; and a batch is judged by the watermark before it. Rows behind it, which
Spark would drop without a word, are written to a reject table together with rows without an event time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portstar.operators.dedup import dedup_by_key
from portstar.operators.joins import bounded_broadcast
from portstar.plans.snapshots import Load, SnapshotStore
from portstar.session import scratch_path

PROGRESS = "progress_of_"
SEEN = "seen_by_"
EVENT_DAY = "event_day"


@dataclass(frozen=True)
class Deduplication:
    """Rows of ``target`` are unique in ``keys`` among events at most ``delay_days`` apart; of the
    repeats within a batch the first by ``event_date`` and then every other column counts."""
    target: str
    rejects: str
    keys: tuple[str, ...]
    event_date: str
    delay_days: int
    partition_by: tuple[str, ...] = ()


def progress(load: Load, rule: Deduplication) -> tuple[int, dt.date | None]:
    """Number of the last batch that was published, and the watermark after it."""
    name = PROGRESS + rule.target
    if name not in load.tables:
        return -1, None
    r = load.table(name).first()
    return r.batch_id, r.watermark


def _add(load: Load, name: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> None:
    if name in load.tables:
        load.append(name, rows)
    else:
        load.replace(name, rows, partition_by)


def take_batch(store: SnapshotStore, batch: DataFrame, batch_id: int, rule: Deduplication) -> None:
    """Publish one micro-batch; does nothing if a batch of this number has been published."""
    load = store.begin(f"batch {batch_id} of {rule.target}")
    done, watermark = progress(load, rule)
    if done >= batch_id:
        return
    spark = load.spark
    path = scratch_path(spark, "stream-batch")
    batch.write.parquet(path)
    rows = spark.read.schema(batch.schema).parquet(path)
    event = F.col(rule.event_date)
    on_time = event.isNotNull() if watermark is None else event.isNotNull() & (event >= F.lit(watermark))
    others = [c for c in rows.columns if c not in rule.keys and c != rule.event_date]
    fresh = dedup_by_key(rows.where(on_time), list(rule.keys), [rule.event_date, *others])
    seen = SEEN + rule.target
    if seen in load.tables:
        known = bounded_broadcast(load.table(seen).select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(rule.keys)]).distinct())
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s{i}")) for i, k in enumerate(rule.keys)])
        fresh = fresh.join(known, same, "left_anti")
    _add(load, rule.target, fresh.select(*rows.columns), rule.partition_by)
    _add(load, rule.rejects, rows.where(~on_time).withColumn(
        "reason", F.when(event.isNull(), "no event time").otherwise("late")).withColumn("batch_id", F.lit(batch_id).cast("long")))
    latest = rows.agg(F.max(rule.event_date)).first()[0]
    behind = None if latest is None else latest - dt.timedelta(days=rule.delay_days)
    watermark = max([w for w in (watermark, behind) if w is not None], default=None)
    _add(load, seen, fresh.select(*rule.keys, event.alias(EVENT_DAY)), (EVENT_DAY,))
    if watermark is not None:
        load.drop_partitions(seen, F.col(EVENT_DAY) < F.lit(watermark.isoformat()))
    load.replace(PROGRESS + rule.target, spark.createDataFrame([(batch_id, watermark)], "batch_id long, watermark date"))
    load.commit()


def stream_deduplicated(spark: SparkSession, source_dir: str, store: SnapshotStore, rule: Deduplication, schema,
                        checkpoint: str, files_per_batch: int | None = None, source_format: str = "parquet"):
    """Run the stream over every file now in ``source_dir`` that earlier runs have not taken, and stop.
    ``checkpoint`` is the stream's own; batches already published are recognised by the store."""
    reader = spark.readStream.schema(schema).format(source_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (reader.load(source_dir).writeStream
             .foreachBatch(lambda batch, batch_id: take_batch(store, batch, batch_id, rule))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
