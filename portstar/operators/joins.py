"""Join helpers: a size-checked broadcast, semi and anti joins of wide rows with keys, and the
referential (anti-join) check."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portstar.operators.key_filter import key_bitmaps, split_by_bitmaps

# Largest build side we broadcast; beyond it the join stays a shuffle join (adaptive execution
# still splits skewed keys there).
BROADCAST_MAX_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if its values take at most ``max_bytes``, else ``df`` unchanged.

    One aggregate adds up the bytes of the strings and 8 bytes for every other value. Nothing is
    cached: a later call over the same path sees what the path holds then.
    """
    return F.broadcast(df) if value_bytes(df) <= max_bytes else df


def value_bytes(df: DataFrame) -> int:
    """Bytes of a frame's strings, and 8 for every other value."""
    sizes = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
             if isinstance(f.dataType, T.StringType) else F.lit(8) for f in df.schema.fields]
    row = sizes[0]
    for size in sizes[1:]:
        row = row + size
    return df.agg(F.sum(row.cast("long")).alias("bytes")).first().bytes or 0


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null keys match null keys."""
    return reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys])


def join_on_keys(rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str,
                 more: Callable[[DataFrame, DataFrame], Column] | None = None,
                 max_bytes: int | None = None) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of wide rows with a side that has each key once.

    A side of at most ``max_bytes`` (``BROADCAST_MAX_BYTES``) is broadcast. A larger one is shuffled, and of the
    rows only those that may have one of its keys; the others are told by bitmaps and stay where they lie.
    """
    def joined(some: DataFrame, side: DataFrame) -> DataFrame:
        on = same_keys(some, side, keys)
        return some.join(side, on if more is None else on & more(some, side), how)

    if value_bytes(side) <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes):
        return joined(rows, F.broadcast(side))
    none, some = split_by_bitmaps(rows, keys, key_bitmaps(side, keys))
    found = joined(some, side)
    return none.unionAll(found) if how == "left_anti" else found


def unmatched_rows(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key finds no row in ``right`` (null keys never match)."""
    keys = right.select(F.col(right_key).alias("_rk")).distinct()
    return left.join(keys, left[left_key] == keys["_rk"], "left_anti")
