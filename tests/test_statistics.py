"""Stored column statistics: merged figures against one pass, and planted drift."""

import pytest
from pyspark.sql import functions as F

from portstar.plans.statistics import column_statistics, drift, merged, profile


@pytest.fixture(scope="module")
def table(spark):
    month = F.pmod(F.col("id"), F.lit(4)).cast("int")
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)).cast("double")
    return spark.range(24_000).select(
        month.alias("month"), h(1).alias("steady"), F.when(month == 2, h(2) + 400).otherwise(h(2)).alias("moved"),
        F.when((month == 3) & (h(3) < 300), None).otherwise(h(3)).alias("thinned"),
        F.concat(F.lit("v"), F.when(month == 1, F.pmod(F.col("id"), F.lit(3))).otherwise(F.pmod(F.col("id"), F.lit(9))))
        .alias("word"), F.concat(F.lit("w"), F.pmod(F.xxhash64("id"), F.lit(20))).alias("calm"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(9)), F.lit(300)).cast("int")).alias("day"),
        F.lit(None).cast("string").alias("empty"))


def test_planted_drift_is_listed_and_nothing_else(table):
    stats = column_statistics(table, ["month"])
    found = {(r.column_name, r.month, r.measure) for r in drift(stats, ["month"]).collect()}
    planted = {("moved", 2, "distribution"), ("moved", 3, "distribution"), ("thinned", 3, "missing"),
               ("word", 1, "frequencies"), ("word", 2, "frequencies")}
    # the values that went missing in month 3 are the low ones, so its distribution moved too
    assert found == planted | {("thinned", 3, "distribution")}


def test_merged_statistics_equal_one_pass(table):
    columns = ["steady", "moved", "thinned", "word", "calm", "day", "empty"]
    stats = column_statistics(table, ["month"])
    got = {r.column_name: r for r in profile(merged(stats)).collect()}
    once = {r.column_name: r for r in profile(merged(column_statistics(table.withColumn("month", F.lit(0)), ["month"]))).collect()}
    for c in columns:
        n = table.where(F.col(c).isNull()).count()
        assert (got[c].total_rows, got[c].missing) == (24_000, n)
        assert (got[c].low, got[c].high) == (once[c].low, once[c].high)
        exact = table.agg(F.count_distinct(c)).first()[0]
        assert abs(got[c].distinct_values - exact) <= max(1, 0.08 * exact)
    median = table.agg(F.median("moved")).first()[0]
    rank = table.where(F.col("moved") <= got["moved"].median).count() / 24_000
    assert abs(rank - 0.5) < 0.03 and abs(got["moved"].median - median) < 60
    two = {r.column_name: r for r in merged(stats.where("month < 2")).collect()}
    assert sum(two["word"].buckets.values()) == 12_000 and two["steady"].buckets == {}
    assert merged(stats.limit(0)).count() == 0 and drift(stats.where("month = 0"), ["month"]).count() == 0
