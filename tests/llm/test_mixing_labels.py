"""Mixture of rows that share ids, and labels without documents."""

from collections import Counter

from pyspark.sql import functions as F

from portstar.llm import mixing, toxicity

DOCS = "doc_id long, text string, source string, extra int"


def test_rows_without_or_with_repeated_ids_draw_and_travel_apart(spark):
    n = 6000
    rows = ([(None, f"text {i}", "a", 1) for i in range(n)] + [(7, f"other {i}", "a", 1) for i in range(n)]
            + [(9, "same", "a", 1)] * n + [(9, "same", "a", 2)] * 5)
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    weights = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    out = mixing.replicate(df, weights)                          # mean 1 for every row
    got = out.select("__row.doc_id", "__row.text", "__row.extra", "n_copies", "copy",
                     F.spark_partition_id().alias("p")).collect()
    for part in (lambda r: r.doc_id is None, lambda r: r.doc_id == 7, lambda r: r.doc_id == 9):
        mine = [r for r in got if part(r)]
        assert abs(len(mine) - n) < 6 * n ** 0.5                 # variance of a Poisson sum, not of one draw
        drawn = Counter(r.n_copies for r in mine if r.copy == 1)
        assert abs(drawn[1] / n - 0.368) < 0.04 and abs(drawn[2] / n - 0.184) < 0.04
        spread = Counter(r.p for r in mine)
        assert len(spread) < 2 or max(spread.values()) < 0.5 * len(mine)
    again = Counter((r.doc_id, r.text, r.extra) for r in mixing.mix(df.repartition(3), weights).collect())
    assert again == Counter((r.doc_id, r.text, r.extra) for r in got)


def test_repeated_rows_with_weight_zero_go_and_unique_rows_are_not_shuffled_for_it(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "x", 1), (2, None, "y", 1), (None, None, "y", 1)], DOCS)
    weights = spark.createDataFrame([("y", 1.0)], "source string, weight double")
    assert {r.source for r in mixing.mix(df, weights).collect()} <= {"y"}
    assert mixing._apart(mixing.packed(df), F.col("__row.doc_id"), F.col("__row.text")).count() == 4


def test_labels_without_documents_neither_fill_the_sample_nor_count(spark, monkeypatch):
    docs = spark.createDataFrame([(i, ("vile nasty words " if i % 2 else "kind and calm words ") * 20 + f"w{i}") for i in range(300)],
                                 "doc_id long, text string")
    labels = spark.range(200_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    seen = {}
    real = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda sample, t, o: seen.update(n=len(sample), t=t, o=o) or real(sample, t, o))
    model = toxicity.train(docs, labels)
    assert model.dictionaries is not None and seen["t"] + seen["o"] == seen["n"] <= 300 and seen["n"] > 200
    assert toxicity.train(docs, labels.limit(0)).dictionaries is None
    assert toxicity.train(docs.limit(0), labels).dictionaries is None
