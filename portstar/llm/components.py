"""Connected components of an undirected link table, as alternating star contractions.

Every round joins each node with the smallest node next to it; hubs are aggregated before they are
joined, so no node's neighbours are ever gathered. The number of rounds grows with the logarithm
of the longest chain. Links and labels stay in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import cut


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links`` but the roots themselves; ``root`` is the
    smallest node of the component. Self links and repeated links do no harm."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e, before = cut(e), None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(state)
        e = cut(_small_star(_large_star(e).distinct()).distinct())
