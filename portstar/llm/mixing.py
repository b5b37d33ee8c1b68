"""Mixing sources to target weights by Poisson replication.

Each source gets a target share of the corpus; its mean repetition rate is the share's size over
the source's own. A document is repeated ``k`` times, ``k`` drawn from a Poisson distribution with
that mean by inverting a uniform number that comes from a hash of the seed, the document's id and its text.
Copies are exploded and dealt out at random: rows go to partitions by a hash of their own and are
sorted by it there.

Sizes are whole-corpus sums of code points. Without explicit weights, shares follow
``size ** temperature``. The corpus keeps its expected total size.

Defined results. Null source: a source of its own. Null text: size 0. A source whose documents are
all empty, or whose weight is 0, repeats at rate 0 and goes. Null id: hashed as an empty string. Rows
that repeat id and text are numbered, so that each has its own draw and place. Very long texts are only
hashed and measured. Empty table: no rows. Extra columns travel along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import cut, packed, table
from portstar.operators.joins import bounded_broadcast

SEED = "mix-1"
TEMPERATURE = 0.5
# exp(-rate) must stay a normal number: larger means are drawn as a sum of equal parts.
PART_MEAN = 500.0
MAX_BROADCAST_BYTES = 32 << 20


def hash_unit(*parts: Column) -> Column:
    """Uniform in [0, 1) from the first 52 bits of an MD5 (any SQL engine can recompute it)."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def poisson_cdf(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... until the rest is below what a 52-bit uniform can reach."""
    top = F.ceil(mean + F.sqrt(mean) * 12 + 40).cast("int")
    p0 = F.exp(-mean)
    first = F.struct(p0.alias("p"), p0.alias("c"), F.array(p0).alias("out"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"),
                        F.concat(s["out"], F.array(s["c"] + p)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), top), first, step)["out"]


def source_rates(docs: DataFrame, weights: DataFrame | None = None,
                 temperature: float = TEMPERATURE) -> DataFrame:
    """``source, rate, parts, cdf`` for each source of ``source, text``.

    ``weights`` (``source, weight``) gives target shares up to a factor; sources it does not name
    get weight 0, and weights of sources that do not occur are left out of the sum. Sums run over
    the small per-source table only.
    """
    size = F.coalesce(F.char_length("text"), F.lit(0)).cast("long")
    sizes = docs.groupBy("source").agg(F.sum(size).cast("double").alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        w = weights.groupBy(F.col("source").alias("s")).agg(F.sum("weight").alias("weight"))
        sizes = (sizes.join(w, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
                      .withColumn("weight", F.coalesce(F.col("weight").cast("double"), F.lit(0.0))))
    total = sizes.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(total.weight or 1.0)
    rate = F.when(F.col("size") > 0, share * F.lit(total.size or 0.0) / F.col("size")).otherwise(0.0)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN).cast("int"))
    return (sizes.withColumn("rate", rate).withColumn("parts", parts)
                 .withColumn("cdf", poisson_cdf(F.col("rate") / F.col("parts")))
                 .select("source", "rate", "parts", "cdf"))


def replicate(docs: DataFrame, weights: DataFrame | None = None, doc_id: str = "doc_id",
              text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """``__row, source, n_copies, copy, shuffle_key``: one row per copy, shuffled globally."""
    rates = source_rates(docs.select(F.col(source).alias("source"), F.col(text).alias("text")),
                         weights)
    rates = rates.withColumnRenamed("source", "s")
    taken = rates.agg(F.sum(F.size("cdf") * 8 + F.coalesce(F.octet_length("s"), F.lit(0)) + 24).alias("b")).first().b or 0
    if taken <= MAX_BROADCAST_BYTES:
        rates = F.broadcast(rates)
    # beyond that bound the join shuffles, and adaptive execution splits a hot source

    d = _apart(packed(docs), F.col(f"__row.`{doc_id}`"), F.col(f"__row.`{text}`"))
    d = d.join(rates, F.col(f"__row.`{source}`").eqNullSafe(F.col("s")))

    def draw(j: Column) -> Column:
        u = hash_unit(F.lit(seed), F.col("id"), j.cast("string"))
        return F.size(F.filter("cdf", lambda c: c <= u))

    n = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda a, j: a + draw(j))
    d = d.withColumn("n_copies", n).where("n_copies > 0")
    d = d.select("__row", "id", "n_copies", "rate",
                 F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col("id"), F.col("copy").cast("string")))
    d = d.withColumn("shuffle_key", key).drop("id")
    return d.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def _apart(rows: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """``__row, id``: what draws and order hang on, the id and the text's MD5. Rows that repeat both are
    reduced to distinct rows and counted, and each gets its number among them, so that they draw and
    travel apart however many there are. Only hashes are shuffled to find them."""
    name = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    d = rows.withColumn("id", name)
    again = cut(d.groupBy(F.xxhash64("id").alias("h")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"))
    if again.isEmpty():
        return d
    again = bounded_broadcast(again)
    d = d.withColumn("h", F.xxhash64("id"))
    some = d.join(again, "h", "left_semi").groupBy("__row", "id").agg(F.count(F.lit(1)).alias("c"))
    # rows that differ in other columns only are told apart by their hash
    some = some.select("__row", F.concat_ws("|", "id", F.xxhash64("__row").cast("string")).alias("id"),
                       F.explode(F.sequence(F.lit(1).cast("long"), F.col("c"))).alias("k"))
    return d.join(again, "h", "left_anti").select("__row", "id").unionAll(
        some.select("__row", F.concat_ws("|", "id", F.col("k").cast("string")).alias("id")))


def mix(docs: DataFrame, weights: DataFrame | None = None, **names) -> DataFrame:
    """The mixed corpus with the columns of ``docs``."""
    return replicate(docs, weights, **names).select("__row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return replicate(docs).select(
        "__row.doc_id", "__row.source", "__row.lang", "__row.text", "n_copies", "copy", F.round("rate", 6).alias("rate"),
        "shuffle_key")


ORACLE = """
WITH RECURSIVE s AS (
  SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size FROM documents GROUP BY source
), r AS (
  SELECT source, CASE WHEN size > 0 THEN pow(size, 0.5) / (SELECT sum(pow(size, 0.5)) FROM s)
    * (SELECT sum(size) FROM s) / size ELSE 0 END AS rate FROM s
), c AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS cdf FROM r
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), cdf + p * rate / (k + 1) FROM c
  WHERE k < rate + 12 * sqrt(rate) + 40
), d AS (
  SELECT doc_id, source, lang, text,
    ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|1'), 1, 13))::BIGINT::DOUBLE
      / 4503599627370496 AS u
  FROM documents
), n AS (
  SELECT d.doc_id, d.source, d.lang, d.text, r.rate,
    (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM d.source AND c.cdf <= d.u)::INTEGER
      AS n_copies
  FROM d JOIN r ON r.source IS NOT DISTINCT FROM d.source
), e AS (
  SELECT *, unnest(range(1, n_copies + 1))::INTEGER AS copy FROM n
)
SELECT doc_id, source, lang, text, n_copies, copy, round(rate, 6) AS rate,
  md5('mix-1|order|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|' || copy) AS shuffle_key
FROM e
"""
