"""Space-filling layout: files that are narrow in several columns at once, and reads that skip by bounds.

Rows are range-ordered by a Z value, the interleaved bits of each column's place among ``1 << BITS``
equally filled steps (for text: of its leading bytes). Each file then covers a small box of the columns,
so that a filter on any of them opens few files, where a partitioned table serves its partition columns
only. The bounds of each file are kept in a small table beside the data; a read picks its files there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 10
ACCURACY = 2_000


def _number(df: DataFrame, name: str) -> Column:
    """An order-keeping number for a column: text by its first six bytes, dates by their day."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        six = F.substring(F.concat(F.hex(F.encode(c, "UTF-8")), F.lit("0" * 12)), 1, 12)
        return F.conv(six, 16, 10).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampNTZType, T.TimestampType)):
        return F.unix_date(c.cast("date")).cast("double")
    return c.cast("double")


def _place(x: Column, borders: Sequence[float]) -> Column:
    """How many of the ascending ``borders`` are at most ``x`` (0 for null): each step halves what is left. The
    one-element array has ``x`` computed once a row, not once a step."""
    fine, n = F.lit(list(borders) or [0.0]), len(borders)
    halves = F.lit([1 << b for b in reversed(range(n.bit_length()))] or [1])
    return F.transform(F.array(x), lambda v: F.aggregate(halves, F.lit(0), lambda at, half: F.when(
        (at + half <= n) & (F.get(fine, at + half - 1) <= v), at + half).otherwise(at)))[0]


def z_value(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Interleaved bits of the columns' steps; nulls in the lowest step. The steps' borders are
    approximate quantiles of the whole table, at most ``1 << bits`` numbers a column."""
    steps = (1 << bits) - 1
    shares = [i / (steps + 1) for i in range(1, steps + 1)]
    borders = df.select([F.array_sort(F.array_distinct(F.percentile_approx(_number(df, c), shares, ACCURACY))).alias(f"b{i}")
                         for i, c in enumerate(columns)]).first()
    out = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        found = borders[i] or []
        place = _place(_number(df, c), [float(v) for v in found])
        # few distinct values are spread over all steps, so that every column splits at the top
        place = F.coalesce(F.floor(place * F.lit(steps + 1) / (len(found) + 1)), F.lit(0)).cast("long")
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(columns) + i))
    return out


def write_z_ordered(df: DataFrame, path: str, columns: Sequence[str], files: int) -> None:
    """Write about ``files`` files below ``path``/data, range-ordered by the columns' Z value, and each
    file's bounds of those columns below ``path``/bounds."""
    spark = df.sparkSession
    # the hash deals rows of one box that alone exceeds a file over several
    ordered = df.withColumn("_z", z_value(df, columns)).withColumn("_h", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    ordered.repartitionByRange(files, "_z", "_h").sortWithinPartitions("_z").drop("_z", "_h").write.parquet(f"{path}/data")
    written = spark.read.schema(df.schema).parquet(f"{path}/data").select("*", F.col("_metadata.file_name").alias("_file"))
    bounds = [f(f"`{c}`").alias(f"{n}_{c}") for c in columns for f, n in ((F.min, "low"), (F.max, "high"))]
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in columns]
    written.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), *bounds, *nulls).write.parquet(f"{path}/bounds")


def files_for(spark: SparkSession, path: str, where: dict[str, tuple]) -> list[str]:
    """Files whose bounds meet all the closed ranges ``{column: (low, high)}``."""
    fits = F.lit(True)
    for c, (low, high) in where.items():
        fits = fits & (F.col(f"low_{c}") <= F.lit(high)) & (F.col(f"high_{c}") >= F.lit(low))
    return sorted(f"{path}/data/{r._file}" for r in spark.read.parquet(f"{path}/bounds").where(fits).select("_file").collect())


def read_z_ordered(spark: SparkSession, path: str, schema: T.StructType, where: dict[str, tuple]) -> DataFrame:
    """Rows within the closed ranges ``{column: (low, high)}``; opens only files that may hold some."""
    files = files_for(spark, path, where)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    for c, (low, high) in where.items():
        rows = rows.where(F.col(f"`{c}`").between(F.lit(low), F.lit(high)))
    return rows
