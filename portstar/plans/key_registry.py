"""Surrogate ids that later loads never change: an append-only table of natural key and id.

A load numbers only the natural keys that the registry does not hold yet, from the largest stored id
on, in the order of the key columns (``dense_key``: two passes, no single-partition window). Ids of
known keys come from the registry, so a rebuild with more rows gives every old row its old id. The
registry is a table of a :class:`~portstar.plans.snapshots.SnapshotStore`, published together with the
tables that use the ids: a load that dies has numbered nothing, and of two loads at once one fails
instead of both giving one id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.operators.surrogate import dense_key
from portstar.plans.snapshots import Load


def _on(left: DataFrame, right: DataFrame, natural: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[f"`{c}`"].eqNullSafe(right[f"`{c}`"]) for c in natural])


def register(load: Load, registry: str, rows: DataFrame, natural: Sequence[str], name: str = "id") -> DataFrame:
    """Give ids to the natural keys in ``rows`` that have none; the registry as the load would publish
    it (``name`` bigint, then the natural key columns). Null is a value of a key like any other."""
    natural = list(natural)
    keys = rows.select(*[f"`{c}`" for c in natural]).distinct()
    if registry not in load.tables:
        load.replace(registry, dense_key(keys, natural, name), keys=natural)
        return load.table(registry)
    known = load.table(registry)
    new = keys.join(known, _on(keys, known, natural), "left_anti")
    last = known.agg(F.max(name)).first()[0] or 0
    numbered = dense_key(new, natural, "_n")
    load.append(registry, numbered.select((F.col("_n") + last).alias(name), *[f"`{c}`" for c in natural]), evolve=False)
    return load.table(registry)


def with_ids(rows: DataFrame, registry: DataFrame, natural: Sequence[str], name: str = "id") -> DataFrame:
    """``rows`` with the id of their natural key in front. The join is a shuffle join on the whole
    key, as the registry grows with the data; adaptive execution splits keys that many rows share."""
    natural = list(natural)
    known = registry.select(F.col(name), *[F.col(f"`{c}`").alias(f"_r{i}") for i, c in enumerate(natural)])
    on = reduce(lambda a, b: a & b, [rows[f"`{c}`"].eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(natural)])
    return rows.join(known, on).select(name, *[rows[f"`{c}`"] for c in rows.columns])
