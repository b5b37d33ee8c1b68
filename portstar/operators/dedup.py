"""Keep one row per key, chosen by a stated order.

Written as a grouped ``min``/``max`` of a struct rather than ``row_number() over (partition by
key)``: the aggregate combines on the map side, so a key holding a third of all rows is reduced
in every input task before the shuffle instead of landing whole in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portstar.operators.key_filter import key_bitmaps, split_by_bitmaps


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                 descending: bool = False, nulls_last: bool = True) -> DataFrame:
    """One row per ``keys`` value: the first row when sorted by ``order_by``.

    ``order_by`` defaults to every non-key column in frame order; columns not named in it still
    break remaining ties, so the surviving row is fully determined. Null is a key like any
    other. ``nulls_last`` puts rows with a null in an ordering column after filled ones.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by is not None else list(rest)
    unknown = [c for c in order if c not in rest]
    if unknown:
        raise ValueError(f"order_by columns not in frame (or are keys): {unknown}")
    tail = [c for c in rest if c not in order]
    fields = []
    for i, c in enumerate(order):
        # min picks False first, max picks True first; choose the flag so that nulls sort as asked
        null_flag = F.col(c).isNull() if nulls_last != descending else F.col(c).isNotNull()
        fields.append(null_flag.alias(f"_f{i}"))
        fields.append(F.col(c).alias(c))
    fields.extend(F.col(c).alias(c) for c in tail)
    pick = (F.max if descending else F.min)(F.struct(*fields)).alias("_pick")
    picked = df.groupBy(*keys).agg(pick)
    return picked.select(*[F.col(c) for c in df.columns if c in keys] +
                         [F.col(f"_pick.`{c}`").alias(c) for c in rest]).select(*df.columns)


def dedup_repeated(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """:func:`dedup_by_key` for stored rows: the keys are counted first, without the other columns, and only
    rows that may share theirs are sorted and shuffled. Reads ``df`` three times, so it has to give the same
    rows each time."""
    again = duplicate_keys(df.select([F.col(f"`{k}`") for k in keys]), keys, "__n")
    once, more = split_by_bitmaps(df, keys, key_bitmaps(again, keys))
    # grouping makes a negative zero among the keys a zero
    zeros = {k: F.when(F.col(f"`{k}`") == 0, F.lit(0).cast(df.schema[k].dataType)).otherwise(F.col(f"`{k}`"))
             for k in keys if isinstance(df.schema[k].dataType, (T.DoubleType, T.FloatType))}
    return once.withColumns(zeros).unionAll(dedup_by_key(more, keys, order_by))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "count") -> DataFrame:
    """Key values that occur more than once, with their row count (partial counts pre-shuffle)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
              .where(F.col(count_name) > 1))
