"""Every pipeline stage on its own input against plain Python, registration, and op3's own columns."""

import hashlib
import math
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from portstar.llm import decontamination, sharding, toxicity

SF = "/root/testdata/sf0.001"
STAGES = dict(pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert {n for n in entry.oracle_sql() if n.startswith("op")} >= {"op1_prefix_targets", "op4_poisson_mixture",
                                                                     "op10_url_bloom_filter", "op11_skip_list_fim"}
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "mix", "shard"]


def test_toxicity_stage_keeps_exactly_what_the_model_scores_low(spark, docs):
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = docs.collect()
    scores = model.scorer()([r.text for r in rows])
    got = STAGES["toxicity"](spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r, s in zip(rows, scores) if s < 0.5)


def test_decontamination_stage_drops_what_holds_an_item(spark, docs):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in STAGES["decontaminate"](spark, docs, SF).collect()}
    k = decontamination.WINDOW
    windows = []
    for t in items:
        w = decontamination.template(t)[0]
        windows.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)})
    for r in docs.collect():
        w = decontamination.template(r.text)[0]
        own = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
        share = max((len(x & own) / len(x) for x in windows if x), default=0)
        if share >= 0.9:
            assert r.doc_id not in left
        if share == 0:
            assert r.doc_id in left


def test_mixing_stage_draws_poisson_counts(spark, docs):
    rows = docs.collect()
    size = Counter()
    for r in rows:
        size[r.source] += len(r.text or "")
    total, weights = sum(size.values()), sum(s ** 0.5 for s in size.values())
    rate = {s: (n ** 0.5 / weights) * total / n for s, n in size.items() if n}
    want = Counter()
    for r in rows:
        name = f"mix-1|{r.doc_id}|{hashlib.md5((r.text or '').encode()).hexdigest()}|1"
        u, k, p = int(hashlib.md5(name.encode()).hexdigest()[:13], 16) / (1 << 52), 0, math.exp(-rate[r.source])
        c = p
        while c <= u:
            k += 1
            p *= rate[r.source] / k
            c += p
        want[r.doc_id] = k
    got = Counter(r.doc_id for r in STAGES["mix"](spark, docs, SF).collect())
    assert got == +want


def test_shard_stage_places_every_row_once(spark, docs):
    out = STAGES["shard"](spark, docs, SF).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter((r.doc_id, r.text) for r in docs.collect())
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(pipeline.N_SHARDS)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(n))


def test_shard_query_columns(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.query(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
