"""Stand-ins for the two raw inputs, derived by Spark from the driver's test tables.

The real inputs are a SAS file of arrival records and a ';' file of city demographics. On the
test tables they are played by:

* arrivals: one record per ``lineitem`` row, joined to its order and customer. Order date is the
  arrival day, ship date the departure day (missing on lines 3 and 6), the customer's nation the
  state (missing for nation 7), return flag + line status the port (missing for flag 'N'), the
  order priority the rarely filled occupation. ``l_orderkey*10 + l_linenumber`` is the record id;
  the test tables repeat (order, line) pairs, so ids repeat and deduplication has work to do.
* demographics: one row per customer ("city") with its nation as state and market segment as
  race; nation 3 has no demographics, so some trips find no state to join to.

Both grow linearly with the test tables. The join order is orders x customer first (order-sized),
then lineitem, so the lineitem-sized side is shuffled once. Columns that follow from one table's row are made
before the joins, so that what they are made from is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portstar.functions.dates import sas_day_of
from portstar.sources.readers import read_testdata

# Fixed values of the stand-in: the nation whose trips carry no state, and the nation left out of
# the demographics.
STATELESS_NATION = 7
UNCOVERED_NATION = 3


def _state_text(nation: F.Column) -> F.Column:
    return F.lpad(nation.cast("string"), 2, "0")


def arrivals_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SAS-shaped arrival records (13 source columns, numerics as doubles)."""
    line_no = F.col("l_linenumber")
    line = read_testdata(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(F.col("l_returnflag") != "N",
               F.concat(F.col("l_returnflag"), F.col("l_linestatus"))).alias("i94port"),
        F.when(line_no % 3 != 0, sas_day_of(F.col("l_shipdate"))).alias("depdate"),
        (F.col("l_quantity") >= 49).alias("_heavy"))
    orders = read_testdata(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", sas_day_of(F.col("o_orderdate")).alias("arrdate"), "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", F.lit("F"))
         .when(F.col("o_orderstatus") == "O", F.lit("M")).alias("gender"))
    customer = read_testdata(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.substring(F.col("c_mktsegment"), 1, 2).alias("airline"))
    order_customer = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    # Both sides grow with the data, so this is a sort-merge join (it spills, and adaptive
    # execution splits a hot order key). The hint also stops the planner from broadcasting the
    # lineitem side when a small file size estimate slips under the broadcast threshold.
    rows = line.join(order_customer.hint("merge"),
                     line.l_orderkey == order_customer.o_orderkey, "inner")
    nation = F.col("c_nationkey")
    return rows.select(
        (F.col("l_orderkey") * 10 + line_no).cast("double").alias("cicid"),
        nation.cast("double").alias("i94cit"),
        (F.col("l_suppkey") % 25).cast("double").alias("i94res"),
        F.col("i94port"),
        F.col("arrdate"),
        F.when(nation != STATELESS_NATION, _state_text(nation)).alias("i94addr"),
        F.col("depdate"),
        (line_no % 3 + 1).cast("double").alias("i94visa"),
        F.when(F.col("_heavy"), F.col("o_orderpriority")).alias("occup"),
        (F.col("c_custkey") % 60 + 1940).cast("double").alias("biryear"),
        F.col("gender"),
        F.col("airline"),
        F.col("l_suppkey").cast("string").alias("fltno"),
    )


def with_bad_cells(arrivals: DataFrame) -> DataFrame:
    """Arrivals in which every 7th line of an order has a fractional id and every 5th a day number
    beyond the calendar: rows that staging has to keep apart."""
    line_no = F.col("cicid") % 10
    return arrivals.withColumns({
        "depdate": F.when(line_no == 5, F.lit(5e6)).otherwise(F.col("depdate")),
        "cicid": F.when(line_no == 7, F.col("cicid") + 0.5).otherwise(F.col("cicid"))})


def demographics_from_testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City-demographics rows with the file's 12 column names."""
    customer = read_testdata(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_testdata(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner")
    key = F.col("c_custkey")
    balance = F.abs(F.col("c_acctbal"))
    male = (key % 5000 + 1000).cast("int")
    female = (F.floor(balance) + 1000).cast("int")
    return rows.select(
        F.col("c_name").alias("City"),
        F.col("n_name").alias("State"),
        ((key % 30 + 25).cast("double") + F.lit(0.5)).alias("Median Age"),
        male.alias("Male Population"),
        female.alias("Female Population"),
        (male + female).cast("int").alias("Total Population"),
        F.when(key % 40 != 0, (key % 997).cast("int")).alias("Number of Veterans"),
        F.floor(balance / 3).cast("int").alias("Foreign-born"),
        F.when(key % 45 != 0, F.lit(1.5) + (key % 20).cast("double") / 10)
         .alias("Average Household Size"),
        F.when(F.col("c_nationkey") != UNCOVERED_NATION, _state_text(F.col("c_nationkey")))
         .alias("State Code"),
        F.col("c_mktsegment").alias("Race"),
        (key % 1000 + 1).cast("int").alias("Count"),
    )
