"""Near-duplicates: component labels, rows without ids, and brute-force recall on real copies."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from portstar.llm import near_dedup

DOCS = "doc_id long, text string, root string, o string"


def _df(spark, rows):
    return spark.createDataFrame([(i, t, "r", "o") for i, t in rows], DOCS)


def _text(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_rows_without_ids_send_each_class_once_to_python(spark, monkeypatch):
    """1,500 texts without id: the texts fetched for the exact check are those of linked classes."""
    rng = random.Random(1)
    base = _text(rng, 60)
    rows = [(None, _text(rng, 40)) for _ in range(1500)] + [(None, base), (None, base + " more"), (7, base + " end")]
    joined = []
    real = near_dedup.shingle_sets
    monkeypatch.setattr(near_dedup, "shingle_sets", lambda docs, nodes, words: joined.append(
        (docs.select("row").join(nodes.select("row"), "row").count(), nodes.count())) or real(docs, nodes, words))
    got = near_dedup.near_components(_df(spark, rows)).collect()
    assert len(got) == len(rows)
    assert joined[0][0] == joined[0][1] <= 10
    linked = [r for r in got if r.component_id == 7]
    assert len(linked) == 3 and all(r.component_id is None for r in got if r not in linked)
    assert near_dedup.keep_one(_df(spark, rows)).count() == 1501


def test_chains_and_repeated_ids_get_the_smallest_id(spark):
    rng = random.Random(2)
    words = _text(rng, 200).split()
    rows = []
    for k in range(10):                                   # each differs from the next by a few words
        w = list(words)
        for j in range(4 * k):
            w[j] = f"x{j}"
        rows.append((90 - k, " ".join(w)))
    rows += [(81, "other text with that id " + _text(rng, 30)), (5, _text(rng, 30)), (5, rows[3][1])]
    got = near_dedup.near_components(_df(spark, rows)).collect()
    chain = Counter(r.component_id for r in got)
    assert chain[5] == 12 and chain[81] == 1
    kept = near_dedup.keep_one(_df(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [5, 5, 81]
    assert {r.text for r in kept if r.doc_id == 5} == {rows[-2][1], rows[3][1]}


def test_all_pairs_recall_on_sf01(spark):
    """Every pair at 0.8 or more of a tenth of sf0.1, found by an inverted index over all shingles."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(F.col("doc_id") < 1500).select("doc_id", "text")
    sets, index = {}, defaultdict(list)
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        k = min(4, len(w))
        sets[r.doc_id] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
        for s in sets[r.doc_id]:
            index[s].append(r.doc_id)
    shared = Counter((a, b) for ids in index.values() for i, a in enumerate(ids) for b in ids[i + 1:])
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.doc_id: r.component_id for r in near_dedup.near_components(docs).collect()}
    assert len(pairs) > 20 and got == {i: find(i) for i in sets}
