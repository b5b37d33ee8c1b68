"""Shards, mixtures and pseudonyms."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from portstar.llm import mixing, pii, sharding
from portstar.llm.common import cut, unit

DOCS = "doc_id long, text string, source string, shard string, rid long"


def _docs(spark, n=5000):
    rows = [(i, f"text {i}", "s%d" % (i % 3), "x", 0) for i in range(n)]
    rows += [(None, None, None, "x", 0), (1, "", "s1", "x", 0)] + [(7, "copy", "s0", "x", 0)] * 50
    return spark.createDataFrame(rows, DOCS).repartition(7), rows


def test_shards_are_exact_and_gapless(spark):
    df, rows = _docs(spark)
    rid = cut(df.select("doc_id", F.monotonically_increasing_id().alias("rid")))
    got = sharding.place(rid, 8, block_bits=6).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.slot)
    sizes = [len(v) for v in shards.values()]
    assert len(shards) == 8 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    # a uniform shuffle: neighbours part, and the source order leaves no trace
    first = [r.shard for r in got if r.doc_id is not None and r.doc_id < 1600]
    chi = sum((n - len(first) / 8) ** 2 / (len(first) / 8) for n in Counter(first).values())
    assert chi < 30


def test_full_rows_keep_their_columns(spark):
    df, rows = _docs(spark, 500)
    out = sharding.shuffle_into_shards(df, 3)
    assert set(out.columns) == {"doc_id", "text", "source", "rid", "shard", "slot"}
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r[0], r[1]) for r in rows)
    assert sharding.shuffle_into_shards(df.limit(0), 3).count() == 0


@pytest.mark.parametrize("total,marked,draws", [(10, 4, 5), (100, 3, 50), (1000, 500, 10), (8, 8, 3), (5, 0, 5)])
def test_hypergeometric_follows_its_distribution(spark, total, marked, draws):
    n = 4000
    u = unit(11, F.col("id"))
    args = [F.lit(x).cast("long") for x in (total, marked, draws)]
    got = Counter(r.x for r in spark.range(n).select(sharding.hypergeometric(*args, u).alias("x")).collect())
    chi, cells = 0.0, 0
    for x in range(max(0, draws + marked - total), min(draws, marked) + 1):
        e = n * math.comb(marked, x) * math.comb(total - marked, draws - x) / math.comb(total, draws)
        if e >= 5:
            chi, cells = chi + (got[x] - e) ** 2 / e, cells + 1
        got.pop(x, None)
    assert not got and chi < 3 * cells + 15


def test_hypergeometric_large_numbers(spark):
    args = [F.lit(x).cast("long") for x in (10 ** 9, 125 * 10 ** 6, 10 ** 6)]
    x = [r.x for r in spark.range(200).select(
        sharding.hypergeometric(*args, unit(3, F.col("id"))).alias("x")).collect()]
    mean, sd = sum(x) / 200, math.sqrt(10 ** 6 / 8 * 7 / 8)
    assert abs(mean - 125_000) < 5 * sd / math.sqrt(200) and len(set(x)) > 150


def test_mixture_rates_and_draws(spark):
    df, rows = _docs(spark)
    weights = spark.createDataFrame([("s0", 3.0), ("s1", 1.0), ("none", 5.0)], "source string, weight double")
    got = mixing.replicate(df, weights).select("__row.doc_id", "__row.source", "n_copies", "copy").collect()
    assert {r.source for r in got} == {"s0", "s1"}
    size = sum(len(r[1] or "") for r in rows)
    for s, share in (("s0", 3 / 4), ("s1", 1 / 4)):
        own = [r for r in rows if r[2] == s]
        rate = share * size / sum(len(r[1] or "") for r in own)
        copies = sum(r.source == s for r in got)
        assert abs(copies - rate * len(own)) < 6 * math.sqrt(rate * len(own)) + 60
    by = Counter((r.doc_id, r.n_copies) for r in got if r.doc_id not in (1, 7))
    assert all(n == k for (_, k), n in by.items())


def test_mixture_default_keeps_columns_and_empty(spark):
    df, _ = _docs(spark, 300)
    out = mixing.mix(df)
    assert out.columns == df.columns and out.count() > 100
    assert mixing.mix(df.limit(0)).count() == 0
    same = [r.doc_id for r in mixing.mix(df).orderBy("doc_id", "text").collect()]
    assert same == [r.doc_id for r in mixing.mix(df.repartition(3)).orderBy("doc_id", "text").collect()]


def test_poisson_cdf_inversion_and_large_means(spark):
    r = spark.range(1).select(mixing.poisson_cdf(F.lit(2.5)).alias("c")).first().c
    want = 0.0
    for k in range(10):
        want += math.exp(-2.5) * 2.5 ** k / math.factorial(k)
        assert abs(r[k] - want) < 1e-12
    docs = spark.createDataFrame([(i, "x" if i else "y" * 9999, "b" if i else "a") for i in range(11)],
                                 "doc_id long, text string, source string")
    w = spark.createDataFrame([("b", 1.0)], "source string, weight double")
    n = mixing.replicate(docs, w).count()          # mean 1000.9 for each of ten documents
    assert abs(n - 10_009) < 6 * 100


KEY = b"k"
TEXTS = ["mail a.b9@x.org or 10.0.0.1, call +1 (974) 555-3436", "card 4111 1111 1111 1111 and 4111111111111112",
         "born 1984-02-29 or 31/12/1999, not 2021-02-30 nor 999.1.1.1", "ssn 123-45-6789 tok 04dbebab91ab85687d33eeaaf9ac699e",
         "TOKEN = \"9233A8ECF7C5B09FE5949719B6B82BC439E9329B\"!! was.91@mail6.example.com", "version 3. 12 apples",
         "far 0001-01-01 and 9999-12-31", ""]


def test_pseudonyms_round_trip_and_formats():
    for t in TEXTS:
        new, kinds = pii.replace_all(t, KEY)
        assert pii.reveal(new, KEY) == t and len(new) == len(t) or "10.0.0.1" in t
        assert pii.reveal(new, KEY) == t
        for m in pii._PATTERN.finditer(t):
            if m.lastgroup not in ("iso", "dmy", "ip") or "02-30" not in m.group() and "999." not in m.group():
                assert m.group() not in new, (t, new)
    assert pii.luhn("4111111111111111")
    new = pii.replace_all(TEXTS[1], KEY)[0]
    card, other = new.split(" and ")
    assert pii.luhn(card[5:].replace(" ", "")) and not pii.luhn(other) and card[9] == " "
    assert "2021-02-30" in pii.replace_all(TEXTS[2], KEY)[0]
    assert pii.replace_all("version 3. 12 apples", KEY) == ("version 3. 12 apples", [])


def test_permutation_is_one_to_one_without_fixed_points():
    p = pii.Permuter(KEY)
    for n in (2, 3, 10, 97, 100, 1000):
        out = [p.permute(x, n, b"t") for x in range(n)]
        assert sorted(out) == list(range(n)) and all(x != y for x, y in enumerate(out))
        assert [p.permute(y, n, b"t", True) for y in out] == list(range(n))


def test_pseudonyms_link_documents(spark):
    rows = [(1, "call +1 (974) 555-3436 now", "k", 1), (2, "again: +1 (974) 555-3436", "k", 1), (3, None, "k", 1),
            (4, "", "k", 1), (5, "x" * 200_000 + " 10.1.2.3", "k", 1), (5, "10.1.2.3", "k", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kinds string, __new int")
    got = pii.pseudonymise(df, KEY).select("__row.doc_id", "text", "kinds").collect()
    phones = {r.text.split("+1 ")[1][:14] for r in got if r.doc_id in (1, 2)}
    assert len(phones) == 1 and phones != {"(974) 555-3436"}
    by = {r.doc_id: r for r in got}
    assert by[3].text is None and by[4].text == "" and len(got) == 6
    assert len({r.text[-9:].strip("x ") for r in got if r.doc_id == 5}) == 1
    assert pii.pseudonymise(df.limit(0), KEY).count() == 0
