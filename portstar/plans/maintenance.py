"""Keeping the warehouse current: incremental upserts, archiving, bucketed layout, summaries.

An incremental load replaces the stored rows of its keys wherever they lie, rewrites only the
partitions that hold such rows and appends the rest. Partitions are chosen by a literal filter on
the partition columns, so other directories are never opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portstar.operators.dedup import dedup_by_key
from portstar.session import delete_folders, scratch_path
from portstar.sources.readers import read_table
from portstar.sources.sinks import TableSpec, WriteResult, write_table


def _null_safe_match(left_cols: Sequence[str], right_prefix: str):
    return reduce(lambda a, b: a & b,
                  [F.col(c).eqNullSafe(F.col(f"{right_prefix}{c}")) for c in left_cols])


def upsert(existing: DataFrame, updates: DataFrame, keys: Sequence[str],
           order_by: Sequence[str] | None = None) -> DataFrame:
    """``existing`` with every key present in ``updates`` replaced by the update's row.

    Several updates of one key keep the first by ``order_by`` (see ``dedup_by_key``); without
    ``order_by`` the updates are taken as given (one row per key expected, as for the fact whose
    key is every trip column). Keys are compared null-safely, so a null key value replaces a null
    key value.
    """
    keys = list(keys)
    latest = dedup_by_key(updates, keys, order_by) if order_by is not None else updates
    update_keys = latest.select([F.col(k).alias(f"_u_{k}") for k in keys]).distinct()
    kept = existing.join(update_keys, _null_safe_match(keys, "_u_"), "left_anti")
    return kept.unionByName(latest.select(*existing.columns))


def _balanced(terms: list, combine):
    """Combine terms pairwise, so that the depth grows with the logarithm of their number."""
    while len(terms) > 1:
        terms = [combine(*terms[i:i + 2]) if i + 1 < len(terms) else terms[i]
                 for i in range(0, len(terms), 2)]
    return terms[0]


def partition_filter(values: Sequence[tuple], partition_by: Sequence[str]):
    """A literal predicate on partition columns that selects the given partition values.

    Spark applies it to the directory listing, so other partitions are never opened. Values are
    grouped by all but the last column; the tree of alternatives is balanced, whatever its size.
    """
    if not values:
        return F.lit(False)
    groups: dict[tuple, list] = {}
    for value in values:
        groups.setdefault(tuple(value[:-1]), []).append(value[-1])
    last, terms = F.col(partition_by[-1]), []
    for head, tails in groups.items():
        known = [t for t in tails if t is not None]
        some = [last.isin(known)] if known else []
        if len(known) < len(tails):
            some.append(last.isNull())
        same = [F.col(p).isNull() if v is None else F.col(p) == F.lit(v)
                for p, v in zip(partition_by, head)]
        terms.append(_balanced([*same, _balanced(some, lambda a, b: a | b)], lambda a, b: a & b))
    return _balanced(terms, lambda a, b: a | b)


def _partition_values(df: DataFrame, partition_by: Sequence[str]) -> list[tuple]:
    """Distinct partition values: at most one for each directory of the table."""
    return [tuple(r) for r in df.select(*partition_by).distinct().collect()]


def touched_partitions(existing: DataFrame, updates: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` in the partitions ``updates`` falls into (no other is opened)."""
    partition_by = list(partition_by)
    return existing.where(partition_filter(_partition_values(updates, partition_by), partition_by))


def _existing(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return read_table(spark, path, schema)
    except Exception as exc:  # first load: no table yet
        if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
        return None


@dataclass(frozen=True)
class LoadResult(WriteResult):
    """A write, and the partition values from which the load took rows or to which it added some."""
    touched: tuple[tuple, ...] = ()


def incremental_load(spark: SparkSession, target_path: str, updates: DataFrame,
                     keys: Sequence[str], partition_by: Sequence[str],
                     order_by: Sequence | None = None, drop: Sequence[str] = (),
                     keys_fix_partition: bool = False, dealt: bool = False) -> LoadResult:
    """Merge ``updates`` into the partitioned Parquet table at ``target_path``: the latest row of
    each key wins, wherever it lies.

    Of several updates of one key the first by ``order_by`` counts (columns in ``drop`` only serve
    this order and are not stored); an update always replaces the stored row, also when it falls
    into another partition. Only the key and partition columns of the whole table are read to find
    stored rows of the same keys. Partitions that hold such rows are rewritten without them;
    everything else is appended, so an increment of new keys rewrites nothing. Where the keys
    determine the partition (``keys_fix_partition``: a row cannot move), stored rows of the same keys
    are only looked for in the increment's own partitions, whatever the table's size.

    The result names the partitions that changed, those that rows left included, for derived tables.

    The first load is written as it comes (``dealt``: its rows are rebalanced on ``partition_by`` already).
    Later increments and the rewritten partitions are staged in the shared checkpoint folder first
    and removed after. The table is changed in steps (replace partitions, append, remove emptied
    folders); a run that fails between them is repaired by running the same increment again.
    """
    keys, partition_by = list(keys), list(partition_by)
    stage = scratch_path(spark, "upsert-stage")
    latest = dedup_by_key(updates, keys, order_by) if order_by is not None else updates
    latest = latest.drop(*drop)
    schema = latest.schema
    append = TableSpec("target", target_path, tuple(partition_by), mode="append")
    existing = _existing(spark, target_path, schema)
    if existing is None:
        result = write_table(latest, replace(append, dealt=dealt))
        return _load_result(result, _partition_values(read_table(spark, target_path, schema), partition_by))
    write_table(latest, TableSpec("increment", f"{stage}/increment"))
    increment = spark.read.schema(schema).parquet(f"{stage}/increment")
    arriving = _partition_values(increment, partition_by)
    if keys_fix_partition:
        existing = existing.where(partition_filter(arriving, partition_by))
    new_keys = increment.select([F.col(k).alias(f"_u_{k}") for k in keys]).distinct()
    same_key = _null_safe_match(keys, "_u_")
    stored = existing.select(*dict.fromkeys([*keys, *partition_by])).join(new_keys, same_key, "left_semi")
    changed = _partition_values(stored, partition_by)
    if not changed:
        result = write_table(increment, append)
        delete_folders(spark, [stage])
        return _load_result(result, arriving)
    in_changed = partition_filter(changed, partition_by)
    kept = existing.where(in_changed).join(new_keys, same_key, "left_anti").unionByName(
        increment.where(in_changed))
    write_table(kept, TableSpec("kept", f"{stage}/kept", tuple(partition_by)))
    rewritten = read_table(spark, f"{stage}/kept", schema)
    emptied = sorted(set(changed) - set(_partition_values(rewritten, partition_by)), key=str)
    folders = [] if not emptied else [r.f for r in existing.where(partition_filter(emptied, partition_by)).select(
        F.regexp_replace(F.input_file_name(), "/[^/]*$", "").alias("f")).distinct().collect()]
    result = write_table(rewritten, TableSpec("target", target_path, tuple(partition_by), mode="overwrite", dealt=True,
                                              options={"partitionOverwriteMode": "dynamic"}))
    rest = increment.where(~F.coalesce(in_changed, F.lit(False)))
    if not rest.isEmpty():
        result = write_table(rest, append)
    delete_folders(spark, [*folders, stage])
    return _load_result(result, [*arriving, *changed])


def _load_result(result: WriteResult, touched: Sequence[tuple]) -> LoadResult:
    return LoadResult(result.table, result.path, result.rows, result.ok, tuple(dict.fromkeys(touched)))


def archive_split(spark: SparkSession, source_path: str, archive_path: str, live_path: str,
                  schema, before_year: int, before_month: int,
                  partition_by: Sequence[str] = ("year", "month")) -> tuple[WriteResult, WriteResult]:
    """Rows of months before (before_year, before_month) go to ``archive_path``, the rest
    (including rows without a year) to ``live_path``. Both keep the partition layout, and the
    predicate is on partition columns, so each side reads only its own directories. Files hold one month
    each, so rows are written by the task that reads them, without a shuffle."""
    table = read_table(spark, source_path, schema)
    old = (F.col("year") < before_year) | ((F.col("year") == before_year) & (F.col("month") < before_month))
    is_old = F.coalesce(old, F.lit(False))
    archived = write_table(table.where(is_old), TableSpec("archive", archive_path, tuple(partition_by), dealt=True))
    live = write_table(table.where(~is_old), TableSpec("live", live_path, tuple(partition_by), dealt=True))
    return archived, live


def write_bucketed(df: DataFrame, table_name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Save ``df`` as an external table bucketed and sorted on ``key``; return it as a table.

    Rows are dealt out by the key first, with the bucketing's own hash, so each bucket is one file.

    Two tables bucketed the same way on the join key join without an exchange on either side.
    """
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(table_name))
    return df.sparkSession.table(table_name)


def refresh_derived(spark: SparkSession, source_path: str, source_schema, target_path: str,
                    derive, changed: DataFrame | Sequence[tuple],
                    partition_by: Sequence[str] = ("year", "month")) -> WriteResult:
    """Recompute the partitions of a derived table (e.g. the daily summary) whose source
    partitions a load changed, and replace only those partitions of ``target_path``; partitions that
    the source no longer has go.

    ``changed`` are partition values (``LoadResult.touched``: also those that rows left) or rows that
    hold them. The source is read through the same literal partition filter as an incremental load, so a
    daily increment re-aggregates one month of data, not the whole table. ``derive`` must keep
    the partition columns (a per-partition aggregate such as ``daily_summary``).
    """
    partition_by = list(partition_by)
    values = _partition_values(changed, partition_by) if isinstance(changed, DataFrame) else [*changed]
    scope = read_table(spark, source_path, source_schema).where(partition_filter(values, partition_by))
    derived = derive(scope)
    spec = TableSpec("derived", target_path, tuple(partition_by), mode="overwrite",
                     options={"partitionOverwriteMode": "dynamic"})
    result = write_table(derived, spec)
    emptied = set(values) - set(_partition_values(scope, partition_by))
    if emptied:
        left = read_table(spark, target_path, derived.schema).where(partition_filter(sorted(emptied, key=str), partition_by))
        folder = F.regexp_replace(F.input_file_name(), "/[^/]*$", "")
        delete_folders(spark, [r.f for r in left.select(folder.alias("f")).distinct().collect()])
    return result
