"""Sharding by a hypergeometric communication matrix.

A uniform random permutation of all rows into shards of exact size, without a global sort:

1. rows keep the block they stand in (a slice of a source partition);
2. how many rows of each block go to each shard is drawn *exactly* as in a uniform permutation: a
   multivariate hypergeometric matrix whose row sums are the block sizes and whose column sums are
   the shard sizes;
3. each block is permuted locally and cut by its row of the matrix;
4. rows are exchanged, and each shard is permuted again.

Each matrix row is a chain of hypergeometric draws (inversion from the mode outward, from a seeded
hash), written with DataFrame functions only. Blocks hang in a tree of two levels, so that no task
draws more than about the square root of the number of blocks.

Shard sizes differ by at most one row. Both permutations sort by seeded hashes within pieces of
about ``rows_per_block`` rows; nothing is ever gathered per shard.

Defined results. Rows are told apart by their position, so repeated rows, ties and null ids are
spread like any others. Null text: size 1, CRC of the empty string. Empty table: no rows. Extra
columns travel along in :func:`shuffle_into_shards` whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portstar.llm.common import cut, let, packed, stored, table, unit


def _log_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series at n + 8 (error below 1e-12 relative)."""
    x = n.cast("double") + 8.0
    series = (x * F.log(x) - x + 0.5 * F.log(x * (2 * math.pi)) + 1 / (x * 12.0)
              - 1 / (x * x * x * 360.0) + 1 / (x * x * x * x * x * 1260.0))
    head = n + 1.0
    for i in range(2, 9):
        head = head * (n + float(i))
    return series - F.log(head)


def hypergeometric(total: Column, marked: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` rows taken without replacement from ``total`` are among ``marked``.

    Inversion of the uniform ``u``: the value's probability is walked from the mode outward, over
    at least nine standard deviations on both sides and never outside the support. ``total``,
    ``marked`` and ``draws`` are bigint.
    """
    lo = F.greatest(F.lit(0).cast("long"), draws + marked - total)
    hi = F.least(draws, marked)
    rest = total - marked - draws

    def walk(m: Column) -> Column:
        # ln of C(marked, m) C(total - marked, draws - m) / C(total, draws)
        f = F.transform(F.array(marked, total - marked, draws, total - draws, m, marked - m,
                                draws - m, rest + m, total), _log_factorial)
        return let(F.exp(f[0] + f[1] + f[2] + f[3] - f[4] - f[5] - f[6] - f[7] - f[8]),
                   lambda p: search(m, p))

    def search(m: Column, p: Column) -> Column:
        share = marked.cast("double") / F.greatest(total, F.lit(1).cast("long"))
        spread = F.ceil(F.sqrt(draws * share * (1 - share)) * 9 + 12).cast("long")
        steps = F.least(F.greatest(hi - m, m - lo), spread)
        first = F.struct(F.lit(0).cast("long").alias("i"), (u - p).alias("u"), p.alias("up"),
                         p.alias("down"), F.when(u < p, m).alias("x"))

        def step(s: Column, i: Column) -> Column:
            a, b = m + i, m - i
            up = F.when(a > hi, 0.0).otherwise(
                s["up"] * (marked - a + 1) / a * (draws - a + 1) / (rest + a))
            down = F.when(b < lo, 0.0).otherwise(
                s["down"] * (b + 1) / (marked - b) * (rest + b + 1) / (draws - b))
            nxt = F.struct(
                i.alias("i"), (s["u"] - up - down).alias("u"), up.alias("up"), down.alias("down"),
                F.when(s["u"] < up, a).when(s["u"] < up + down, b).alias("x"))
            return F.when(s["x"].isNotNull(), s).otherwise(nxt)

        path = F.when(steps >= 1, F.sequence(F.lit(1).cast("long"), steps)).otherwise(
            F.array().cast("array<bigint>"))
        return F.coalesce(F.aggregate(path, first, step)["x"], m)

    mode = F.floor((draws + 1).cast("double") * (marked + 1) / (total + 2)).cast("long")
    return let(F.least(hi, F.greatest(lo, mode)), walk)


def draw_row(size: Column, demand: Column, *key: Column | int) -> Column:
    """One row of the matrix: how many of ``size`` rows go to each shard, given what the shards
    still demand. ``demand`` sums up to the rows of this block and all later ones."""
    n = F.size(demand)
    first = F.struct(size.alias("left"),
                     F.aggregate(demand, F.lit(0).cast("long"), lambda a, x: a + x).alias("pop"),
                     F.array().cast("array<bigint>").alias("out"))

    def step(s: Column, i: Column) -> Column:
        want = F.element_at(demand, i)
        return let(hypergeometric(s["pop"], want, s["left"], unit(*key, i)), lambda x: F.struct(
            (s["left"] - x).alias("left"), (s["pop"] - want).alias("pop"),
            F.concat(s["out"], F.array(x)).alias("out")))

    return F.aggregate(F.sequence(F.lit(1), n), first, step)["out"]


def _draw_children(children: Column, demand: Column, seed: int) -> Column:
    """The matrix rows of an ordered array of ``struct<k, n>``: ``array<struct<k, out>>``."""
    first = F.struct(demand.alias("demand"),
                     F.array().cast("array<struct<k:bigint,out:array<bigint>>>").alias("rows"))

    def step(s: Column, c: Column) -> Column:
        return let(draw_row(c["n"], s["demand"], seed, c["k"]), lambda out: F.struct(
            F.zip_with(s["demand"], out, lambda d, x: d - x).alias("demand"),
            F.concat(s["rows"], F.array(F.struct(c["k"].alias("k"), out.alias("out"))))
            .alias("rows")))

    return F.aggregate(children, first, step)["rows"]


def communication_matrix(counts: DataFrame, n_shards: int, seed: int, fan_out: int) -> DataFrame:
    """``block, out`` (rows for each shard) from ``block, n``: exact counts, both sums met."""
    group = F.pmod(F.xxhash64(F.lit(seed), "block"), F.lit(fan_out).cast("long"))
    leaves = counts.groupBy(group.alias("g")).agg(
        F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct(
            F.col("block").alias("k"), F.col("n").alias("n")))).alias("kids"))
    top = leaves.agg(F.array_sort(F.collect_list(F.struct(F.col("g").alias("k"), "n"))).alias("kids"),
                     F.sum("n").alias("total"))
    shard = F.sequence(F.lit(0), F.lit(n_shards - 1))
    sizes = F.transform(shard, lambda s: F.expr(f"total div {n_shards}")
                        + (s < F.expr(f"total % {n_shards}")).cast("long"))
    top = top.where("total is not null").select(
        F.explode(_draw_children(F.col("kids"), sizes, seed)).alias("r"))
    top = top.select(F.col("r.k").alias("g"), F.col("r.out").alias("demand"))
    rows = leaves.select("g", "kids").join(top, "g").select(
        F.explode(_draw_children(F.col("kids"), F.col("demand"), seed + 1)).alias("r"))
    return rows.select(F.col("r.k").alias("block"), F.col("r.out").alias("out"))


ROWS_PER_BLOCK_BITS = 12


def place(rows: DataFrame, n_shards: int, seed: int = 17,
          block_bits: int = ROWS_PER_BLOCK_BITS) -> DataFrame:
    """Adds ``shard`` and ``slot`` to a materialised frame with a unique bigint ``rid``.

    ``rid`` is the row's address: the source partition in its high bits, its position there in the
    low 33 bits, so that ``rid >> block_bits`` names a block of the source. The caller stores the
    frame before (its row order must not change between the count and the cut).
    """
    rows = rows.withColumn("block", F.shiftright("rid", block_bits))
    counts = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    stats = counts.agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("n")).first()
    fan_out = max(1, math.isqrt(stats.blocks))
    pieces = max(1, math.ceil((stats.n or 0) / n_shards / (1 << block_bits)))
    matrix = communication_matrix(counts, n_shards, seed, fan_out)

    # local permutation: a seeded order inside each block, cut at the matrix row's cumulated counts
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 2), "rid"), "rid")
    cut_at = F.aggregate(
        F.col("out"), F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).alias("shard")),
        lambda s, x: F.struct((s["end"] + x).alias("end"),
                              (s["shard"] + (F.col("pos") > s["end"] + x).cast("int")).alias("shard")))
    sent = (rows.withColumn("pos", F.row_number().over(local)).join(matrix, "block")
                .withColumn("shard", cut_at["shard"]).drop("pos", "out", "block"))

    # second permutation: shards are cut into pieces by one seeded hash and sorted by it there
    u = F.xxhash64(F.lit(seed + 3), "rid")
    sent = sent.withColumn("u", u).withColumn(
        "piece", F.floor(unit(seed + 3, F.col("rid")) * pieces).cast("int"))
    sent = sent.withColumn("u", F.shiftrightunsigned("u", 1))
    sizes = sent.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("shard", "piece", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("piece").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    again = Window.partitionBy("shard", "piece").orderBy("u", "rid")
    return (sent.withColumn("k", F.row_number().over(again)).join(before, ["shard", "piece"])
                .withColumn("slot", F.col("before") + F.col("k") - 1)
                .drop("u", "piece", "k", "before"))


def shuffle_into_shards(docs: DataFrame, n_shards: int, seed: int = 17,
                        shard: str = "shard", slot: str = "slot") -> DataFrame:
    """All columns of ``docs`` plus shard and slot; the payload is exchanged once."""
    rows = stored(packed(docs).withColumn("rid", F.monotonically_increasing_id()), "shards")
    placed = place(rows.select("rid"), n_shards, seed)
    own = [F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c not in (shard, slot)]
    return rows.join(placed, "rid").select(
        *own, F.col("shard").alias(shard), F.col("slot").alias(slot))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    narrow = cut(docs.select(
        "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.monotonically_increasing_id().alias("rid")))
    return place(narrow, 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
        F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
