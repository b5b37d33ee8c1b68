"""Column statistics per partition, stored and merged: profiles of any months without a scan, and drift.

One row for each partition and column holds row and missing counts, bounds, a distinct-count sketch, a
quantile sketch of numbers and dates (KLL) and the counts of ``BUCKETS`` hash buckets of texts. All of
them merge: counts add up, bounds widen, sketches unite. :func:`drift` compares each period with the
one before by the share of missing values, the largest gap between the two distributions at the
quantiles of the earlier one, and the total variation of the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
POINTS = 50                    # steps of the quantiles compared
SKETCH_ERROR = 0.04            # of both quantile sketches and of the steps
MISSING_LIMIT, GAP_LIMIT, VARIATION_LIMIT = 0.05, 0.10, 0.10
NOISE = 3.0                    # standard errors of a small period's shares


def _number(df: DataFrame, name: str) -> Column:
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c).cast("double")
    return c.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")


def column_statistics(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``<by>, column_name, total_rows, missing, low, high, numbers, values, buckets``: one pass over the
    table, combined in the map tasks, one small shuffle."""
    columns = [c for c in (columns or df.columns) if c not in by]
    entries = [F.struct(F.lit(c).alias("column_name"), _number(df, c).alias("x"), F.when(
        F.lit(isinstance(df.schema[c].dataType, T.StringType)), F.col(f"`{c}`").cast("string")).alias("t")) for c in columns]
    long = df.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.*")
    bucket = F.pmod(F.xxhash64("t"), F.lit(BUCKETS)).cast("int")
    long = long.withColumn("bucket", F.when(F.col("t").isNotNull(), bucket))
    value = F.coalesce(F.col("t"), F.col("x").cast("string"))
    part = long.groupBy(*by, "column_name", "bucket").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(value.isNull()).alias("missing"),
        F.min("x").alias("low"), F.max("x").alias("high"), F.min("t").alias("low_text"), F.max("t").alias("high_text"),
        F.kll_sketch_agg_double("x").alias("numbers"), F.hll_sketch_agg(value).alias("values"))
    return _united(part, by)


def _united(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of one group and column made one; ``bucket`` rows become the map ``buckets``."""
    counted = F.map_from_entries(F.collect_list(F.when(F.col("bucket").isNotNull(), F.struct("bucket", "total_rows"))))
    return parts.groupBy(*by, "column_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("missing").alias("missing"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.kll_merge_agg_double("numbers").alias("numbers"), F.hll_union_agg("values").alias("values"),
        counted.alias("buckets"))


def merged(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Statistics of coarser groups, from the stored ones alone."""
    kept = ["low", "high", "low_text", "high_text", "numbers", "values"]
    # a text column's rows go with its buckets, so that each bucket is added up by itself
    spread = F.when(F.size("buckets") > 0, F.map_entries("buckets"))
    rows = stats.select(*by, "column_name", "total_rows", "missing", *kept, spread.alias("spread"))
    texts = rows.where("spread IS NOT NULL").select(*by, "column_name", F.explode("spread").alias("b")).groupBy(
        *by, "column_name", F.col("b.key").alias("bucket")).agg(F.sum("b.value").alias("n"))
    texts = texts.groupBy(*by, "column_name").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("buckets"))
    whole = _united(rows.withColumn("bucket", F.lit(None).cast("int")), by).drop("buckets")
    groups = [*by, "column_name"]
    same = reduce(lambda a, b: a & b, [whole[g].eqNullSafe(texts[g]) for g in groups])
    return whole.join(texts, same, "left").select(*[whole[c] for c in whole.columns], F.coalesce(
        texts["buckets"], F.create_map().cast("map<int,bigint>")).alias("buckets"))


def profile(stats: DataFrame) -> DataFrame:
    """``total_rows, missing, low, high, distinct_values, median`` from statistics, bounds as text."""
    median = F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("numbers", F.lit(0.5)))
    keep = [c for c in stats.columns if c not in ("low", "high", "low_text", "high_text", "numbers", "values", "buckets")]
    return stats.select(*keep, F.coalesce("low_text", F.col("low").cast("string")).alias("low"),
                        F.coalesce("high_text", F.col("high").cast("string")).alias("high"),
                        F.hll_sketch_estimate("values").alias("distinct_values"), median.alias("median"))


def drift(stats: DataFrame, order: Sequence[str]) -> DataFrame:
    """``column_name, <order>, measure, value, limit`` where a period differs from the one before by more
    than the limit. Limits allow for the sampling noise of small periods and the sketches' error."""
    w = Window.partitionBy("column_name").orderBy(*order)        # one row for each period of a column
    state = F.struct("total_rows", "missing", "low", "numbers", "buckets")
    d = stats.select("column_name", *order, state.alias("now"), F.lag(state).over(w).alias("old")).where("old IS NOT NULL")
    # a period without a value has no distribution: null, and so never beyond a limit
    filled = {k: F.nullif((F.col(f"{k}.total_rows") - F.col(f"{k}.missing")).cast("double"), F.lit(0.0)) for k in ("now", "old")}
    both = F.least(F.lit(1.0), F.sqrt(1 / filled["now"] + 1 / filled["old"]))
    usable = filled["now"].isNotNull() & filled["old"].isNotNull()

    def share(k: str) -> Column:
        return F.col(f"{k}.missing") / F.col(f"{k}.total_rows")

    ranks = F.lit([i / POINTS for i in range(1, POINTS)])
    quantiles = {k: F.kll_sketch_get_quantile_double(f"{k}.numbers", ranks) for k in ("now", "old")}
    below = lambda k, x: F.size(F.filter(quantiles[k], lambda q: q <= x))
    gap = F.array_max(F.transform(quantiles["old"], lambda x: F.abs(below("now", x) - below("old", x)) / POINTS))
    keys = F.array_union(F.map_keys("now.buckets"), F.map_keys("old.buckets"))
    variation = F.aggregate(keys, F.lit(0.0), lambda a, k: a + F.abs(
        F.coalesce(F.try_element_at(F.col("now.buckets"), k), F.lit(0)) / filled["now"]
        - F.coalesce(F.try_element_at(F.col("old.buckets"), k), F.lit(0)) / filled["old"])) / 2
    numeric = usable & F.col("now.low").isNotNull() & F.col("old.low").isNotNull()
    text = usable & (F.size("now.buckets") > 0) & (F.size("old.buckets") > 0)
    rows_noise = F.sqrt(0.25 / F.col("now.total_rows") + 0.25 / F.col("old.total_rows"))
    measures = [
        ("missing", F.abs(share("now") - share("old")), MISSING_LIMIT + NOISE * rows_noise, F.lit(True)),
        ("distribution", gap, GAP_LIMIT + SKETCH_ERROR + NOISE * both / 2, numeric),
        ("frequencies", variation, VARIATION_LIMIT + both * F.sqrt(F.lit(BUCKETS / 6.0)), text)]
    listed = F.array(*[F.struct(F.lit(n).alias("measure"), F.when(ok, v).alias("value"), limit.alias("limit"))
                       for n, v, limit, ok in measures])
    return d.select("column_name", *order, F.explode(listed).alias("m")).select(
        "column_name", *order, "m.*").where("value > limit")
