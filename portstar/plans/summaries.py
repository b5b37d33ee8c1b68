"""Summary tables kept as counts and sums, maintained by additions and retractions.

The stored state has one row for each group: ``trips``, and for each measure the number of values
and their sum as a decimal, so that taking a value away again restores the state exactly (sums of
doubles would drift). A load adds the signed counts and sums of what it added to and took away from
the source table (:meth:`~portstar.plans.snapshots.Load.changes`) to the groups they touch; a group
without rows goes. Averages are made when the summary is read.

The state is published with the load that changed its source, so readers never see one without the
other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.plans.maintenance import partition_filter
from portstar.plans.snapshots import CHANGE, Load
from portstar.session import scratch_path

SUM_TYPE, VALUE_TYPE = "decimal(38,10)", "decimal(28,10)"


@dataclass(frozen=True)
class Summary:
    """Groups and measures of a summary; ``partition_by`` are some of the groups."""
    name: str
    source: str
    groups: tuple[str, ...]
    measures: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return ["trips", *[f"{kind}_{m}" for m in self.measures for kind in ("n", "sum")]]


DAILY = Summary("daily_summary_state", "immi_demographics",
                ("year", "month", "arrive_date", "immigration_state_code"), ("avg_Total_Population",),
                ("year", "month"))


def deltas(changes: DataFrame, summary: Summary) -> DataFrame:
    """Signed counts and sums of a table's changes, for each group that they alter."""
    sign = F.col(CHANGE).cast("long")
    sums = [F.sum(sign).alias("trips")]
    for m in summary.measures:
        value = F.col(m).cast(VALUE_TYPE)
        sums += [F.sum(F.when(F.col(m).isNotNull(), sign).otherwise(0)).alias(f"n_{m}"),
                 F.coalesce(F.sum((value * sign.cast("decimal(1,0)")).cast(SUM_TYPE)), F.lit(0)).cast(SUM_TYPE)
                 .alias(f"sum_{m}")]
    d = changes.groupBy(*summary.groups).agg(*sums)
    return d.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in summary.columns]))


def refresh(load: Load, summary: Summary) -> None:
    """Bring the summary up to the load's state of its source table; a step of the same load.

    Reads what the load changed, and of the state the partitions those groups lie in.
    """
    spark = load.spark
    path = scratch_path(spark, "summary-delta")
    new = summary.name not in load.tables
    source = load.table(summary.source).withColumn(CHANGE, F.lit(1)) if new else load.changes(summary.source)
    deltas(source, summary).write.parquet(path)
    delta = spark.read.parquet(path)
    groups, columns = list(summary.groups), summary.columns
    if new:
        load.merge(summary.name, delta, keys=groups, partition_by=summary.partition_by)
        return
    state = load.table(summary.name)
    if summary.partition_by:
        # at most one value for each folder of the state
        touched = [tuple(r) for r in delta.select(*summary.partition_by).distinct().collect()]
        state = state.where(partition_filter(touched, summary.partition_by))
    keys = delta.select(*groups)
    same = reduce(lambda a, b: a & b, [state[g].eqNullSafe(keys[g]) for g in groups])
    both = state.join(keys, same, "left_semi").unionByName(delta)
    total = both.groupBy(*groups).agg(*[F.sum(c).cast(SUM_TYPE if c.startswith("sum_") else "long").alias(c)
                                        for c in columns])
    load.merge(summary.name, total.where("trips > 0"), deletes=total.where("trips <= 0").select(*groups))


def averages(state: DataFrame, summary: Summary) -> DataFrame:
    """The summary as read: groups, ``trips`` and the average of each measure."""
    means = [(F.col(f"sum_{m}").cast("double") / F.when(F.col(f"n_{m}") > 0, F.col(f"n_{m}"))).alias(
        "avg_" + m.removeprefix("avg_")) for m in summary.measures]
    return state.select(*summary.groups, "trips", *means)


def roll_up(state: DataFrame, summary: Summary, groups: Sequence[str]) -> DataFrame:
    """The state of coarser groups: counts and sums of the finer ones add up."""
    coarse = state.groupBy(*groups).agg(*[F.sum(c).cast(SUM_TYPE if c.startswith("sum_") else "long").alias(c)
                                          for c in summary.columns])
    return coarse.select(*groups, *summary.columns)
