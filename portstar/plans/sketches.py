"""Distinct-key reports from stored sketches: months are scanned once, any range is merged after.

For each table, key and partition of the source one row holds the exact row and null counts and a
HyperLogLog sketch of the key (``hll_sketch_agg``). Sketches merge by union without loss, so a report
over any months reads the small sketch table only. A load adds the sketches of its own rows; as a
sketch cannot forget, partitions from which rows were taken away are rebuilt from the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 14                      # 2^14 registers: standard error 0.8 %, at most 16 KiB a sketch
ERROR = 1.04 / (1 << (LOG_SIZE // 2))


def key_sketches(df: DataFrame, table: str, keys: Sequence[str], by: Sequence[str], log_size: int = LOG_SIZE) -> DataFrame:
    """``table_name, key_name, <by>, total_rows, null_keys, sketch``: one pass over the table for all keys."""
    entries = F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(f"`{k}`").cast("string").alias("v")) for k in keys])
    long = df.select(*by, F.explode(entries).alias("e"))
    return long.groupBy("e.key_name", *by).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("e.v").isNull()).alias("null_keys"),
        F.hll_sketch_agg("e.v", F.lit(log_size)).alias("sketch")).select(
        F.lit(table).alias("table_name"), "key_name", *by, "total_rows", "null_keys", "sketch")


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketch rows united over all columns but table, key and ``by`` (for instance months to years)."""
    return sketches.groupBy("table_name", "key_name", *by).agg(
        F.sum("total_rows").alias("total_rows"), F.sum("null_keys").alias("null_keys"),
        F.hll_union_agg("sketch").alias("sketch"))


def sketch_report(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Key report from sketches: rows, null keys, estimated distinct keys and the share of repeats."""
    m = merged(sketches, by).withColumn("distinct_keys", F.hll_sketch_estimate("sketch"))
    filled = F.col("total_rows") - F.col("null_keys")
    return m.select("table_name", "key_name", *by, "total_rows", "null_keys", "distinct_keys",
                    F.when(filled > 0, F.greatest(F.lit(0.0), 1 - F.col("distinct_keys") / filled)).alias("repeat_share"))
