"""Decontamination, toxicity, near-duplicates, page text and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from portstar.llm import decontamination as dec
from portstar.llm import html, near_dedup, toxicity
from portstar.llm.components import components

DOCS = "doc_id long, text string, node string, doc_row string, score double"
SF = "/root/testdata/sf0.001"


def _df(spark, rows):
    return spark.createDataFrame([(i, t, "n", "r", 0.5) for i, t in rows], DOCS)


def _bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


FILLER = "the quick brown fox jumps over a lazy dog while seven ships sail past the old grey harbour wall"


def test_reworded_questions_are_found_and_inconsistent_ones_left(spark):
    item = "Alice has 12 apples and gives Bob 5 apples so how many of the 12 apples are left for her"
    rows = [
        (1, f"{FILLER}. {item}. {FILLER}"),
        (2, FILLER + ". " + item.replace("12", "99").replace("Bob", "Carol").replace(" 5 ", " 41 ")),
        (3, item.replace("12 apples and", "7 apples and")),          # 12 stands for 7 and for 12
        (4, FILLER), (5, None), (6, ""), (7, "12 apples"), (2, FILLER), (None, item),
    ]
    found = dec.find_items(dec.with_row_key(_df(spark, rows)), _bench(spark, [(0, item), (1, None), (2, ""), (None, "x")]))
    got = {(r.doc_id, r.item_id): r.reworded for r in found.collect()}
    assert got[(1, 0)] is False and got[(2, 0)] is True and got[(None, 0)] is False
    assert (3, 0) not in got or got[(3, 0)]
    assert not {4, 5, 6, 7} & {d for d, _ in got}
    left = dec.decontaminate(_df(spark, rows), _bench(spark, [(0, item)]))
    assert left.columns == _df(spark, rows).columns
    assert Counter(r.doc_id for r in left.collect() if r.doc_id != 3) == Counter([4, 5, 6, 7, 2])


def test_short_items_and_empty_tables(spark):
    rows = [(1, "we know that water boils soon enough"), (2, "water is cold")]
    found = dec.find_items(dec.with_row_key(_df(spark, rows)), _bench(spark, [(9, "that water boils soon")]))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 9)]
    none = _bench(spark, [])
    assert dec.decontaminate(_df(spark, rows), none).count() == 2
    assert dec.decontaminate(_df(spark, rows).limit(0), none).count() == 0


def test_decontamination_matches_plain_window_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in dec.find_items(dec.with_row_key(docs), bench).collect()}
    words = lambda t: dec.template(t)[0]
    k, items, want = dec.WINDOW, {}, set()
    for r in bench.collect():
        w = words(r.text)
        items[r.item_id] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    for r in docs.collect():
        w = words(r.text)
        own = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
        want |= {(r.doc_id, i) for i, x in items.items() if len(x & own) >= dec.COVERAGE * len(x)}
    assert got == want


def _found(spark, docs, items):
    found = dec.find_items(dec.with_row_key(_df(spark, docs)), _bench(spark, items))
    return {(r.doc_id, r.item_id) for r in found.collect()}


def test_copies_with_one_edit_are_found(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    items = [(n, " ".join(first * 3 + letters[i // 26] + letters[i % 26] for i in range(n)))
             for first, n in zip("pqrst", (10, 15, 16, 22, 40))]
    items.append((99, "the teacher asked John Smith to count 40 chairs in the hall before the show began"))
    docs = []
    for n, text in items[:-1]:
        w = text.split()
        for at in range(n):
            edits = (w[:at] + ["zebra"] + w[at:], w[:at] + w[at + 1:], w[:at] + ["zebra"] + w[at + 1:])
            docs += [(1000 * n + 10 * at + k, f"{FILLER}. {' '.join(e)}. {FILLER}") for k, e in enumerate(edits)]
    docs += [(1, items[-1][1].replace("John Smith", "Ana")), (2, FILLER)]
    assert _found(spark, docs, items) == {(d, d // 1000) for d, _ in docs[:-2]} | {(1, 99)}


def test_one_slot_frees_no_copy(spark):
    item = "a box has 5 red balls and then it also has 5 green balls and 3 blue ones so how many balls are in it"
    change = [("5 green", "7 green"), ("5 red", "5 red"), ("3 blue", "5 blue")]
    docs = [(i, item.replace(*c)) for i, c in enumerate(change)] + [(3, item.replace("5 red", "3 red").replace("5 green", "7 green"))]
    two = [item.replace("5", str(x)).replace("3 blue", f"{y} blue") for x, y in ((99, 4), (7, 81))]
    docs += [(4, ". ".join(two)), (5, FILLER)]
    assert _found(spark, docs, [(0, item)]) == {(i, 0) for i in range(5)}


def test_items_of_few_words_are_found_verbatim(spark):
    items = [(1, "Compute 12 + 7 * 3 - 4"), (2, "12 apples"), (3, "Ann Bob Carl Dora Emil Fritz Gerd Hans Ida Jan"),
             (4, "1 2 3 4 5 6 7 8 9 10 11")]
    docs = [(10 * i, f"{FILLER}: {t} = 23 {FILLER}") for i, t in items]
    docs += [(11, "Compute 13 + 7 * 3 - 4"), (21, "13 apples"), (31, "Ann met Zoe Cob Sarl Mora Tmil Lritz Werd Kans Gda Man"),
             (41, "11 1 10 2 9 3 8 4 7 5 6")]
    assert _found(spark, docs, items) == {(10 * i, i) for i, _ in items}


def _auc(s, y):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    pos = y.sum()
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.1"
    return toxicity.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()


def test_toxicity_held_out_accuracy(scored):
    held = scored[scored.held_out]
    assert (held.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5) == 0).all()
    assert _auc(held.score.to_numpy(), held.toxic.to_numpy()) > 0.88
    assert (held.predicted[held.toxic == 0]).mean() < 0.08
    assert (held.predicted[held.toxic == 1]).mean() > 0.6
    assert scored.score.between(0, 1).all()


def test_toxicity_edge_rows(spark):
    rows = [(i, ("you idiot scum " if i % 2 else "a fine day ") * 5) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "you idiot scum"), (102, "word " * 100_000), (3, rows[3][1])]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, None), (None, 1), (999, 1), (2, 0)],
                                   "doc_id long, toxic int")
    df = _df(spark, rows)
    model = toxicity.train(df, labels)
    got = toxicity.score(df, model).select("__row.doc_id", F.col("score")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({round(r.score, 12) for r in got if r.doc_id in (100, 101)}) == 1
    none = toxicity.train(df, labels.limit(0))
    assert {r.score for r in toxicity.score(df, none).collect()} == {0.0}
    assert toxicity.score(df.limit(0), model).count() == 0


def _near_docs():
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for size in (1, 3, 4, 5, 9, 40, 40, 120, 600):
        base = [rnd.choice(vocabulary) for _ in range(size)]
        for k in range(14):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, size // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            rows.append((i, (" " if k % 2 else "\t").join(w).upper() if k % 3 else " ".join(w)))
            i += 1
    rnd.shuffle(rows)
    return rows + [(900, None), (901, ""), (902, " \n"), (None, rows[0][1]), (rows[1][0], rows[1][1]), (903, "É é")]


def _brute(rows, words=4):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        k = min(words, len(w))
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    low = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            low[find(x)] = min(i, low.get(find(x), i))
    return [(i, len(s), low.get(find(x))) for x, ((i, _), s) in enumerate(zip(rows, sets))]


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 4)          # many chunks even in small buckets
    rows = _near_docs()
    got = near_dedup.near_components(_df(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(_brute(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = near_dedup.keep_one(_df(spark, rows))
    assert kept.columns == _df(spark, rows).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter({r.component_id for r in got if r.component_id is not None})
    clash = [(7, "one two three four five"), (7, "six seven eight nine ten"), (3, "six seven eight nine ten"),
             (None, "a b c d e f"), (None, "g h i j k l"), (None, "a b c d e f"), (8, "a b c d e f")]
    left = Counter((r.doc_id, r.text) for r in near_dedup.keep_one(_df(spark, clash)).collect())
    assert left == Counter([clash[0], clash[2], clash[4], clash[6]])
    assert near_dedup.keep_one(_df(spark, []).limit(0)).count() == 0


def test_shingle_length_is_a_parameter(spark):
    base = [f"w{i}" for i in range(74)]
    edited = base[:20] + ["x"] + base[21:50] + base[51:]     # 4 words: 63 of 78; 5 words: 60 of 79
    df = _df(spark, [(1, " ".join(base)), (2, " ".join(edited))])
    assert near_dedup.keep_one(df).count() == 1
    assert {r.component_id for r in near_dedup.near_components(df).collect()} == {1}
    assert near_dedup.keep_one(df, words=5).count() == 2
    with pytest.raises(ValueError):
        near_dedup.shingle_set("a b", near_dedup._WordNumbers(), 0)


def test_all_rows_without_words_stay(spark):
    rows = [(None, None, "a"), (None, None, "b"), (5, "", "c"), (5, "", "d"), (6, " \n\t", "e"), (6, " \n\t", "f"),
            (1, "one two three", "g"), (1, "one two three", "g"), (7, "\u00a0", "h"), (7, "\u00a0", "h")]
    df = spark.createDataFrame([(i, t, n, "r", 0.5) for i, t, n in rows], DOCS)
    assert Counter(r.node for r in near_dedup.keep_one(df).collect()) == Counter("abcdefgh")


def test_sketch_estimate_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(4)
    passed = Counter()
    for n in (5, 60, 160, 400, 3000, 30_000):
        for percent in (65, 80):
            both = -(-n * percent // 100)
            for _ in range(40):
                h = rng.permutation(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)))
                cut = both + (n - both) // 2
                a, b = np.sort(h[:cut]), np.sort(np.concatenate([h[:both], h[cut:]]))
                w = near_dedup._words([near_dedup.odd_sketch(a), near_dedup.odd_sketch(b)])
                passed[n, percent] += bool(near_dedup.may_be_near(w[:1], w[1:], np.array([len(a)]), np.array([len(b)]))[0])
    assert all(passed[n, 80] == 40 for n in (5, 60, 160, 400, 3000, 30_000)), passed
    assert all(passed[n, 65] == 0 for n in (160, 400, 3000, 30_000)), passed


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


PAGE = ("<html><head><title>t</title></head><body><nav><a href=/>home</a> menu words</nav><div class=\"ad\">buy it now</div>"
        "<article><h1>Title {i}</h1><p>One &amp; two\n three<br>four</p><p>five <b>si</b>x</p>{x}</article>"
        "<footer>&copy; site words here</footer></body></html>")


def test_page_text(spark):
    pages = [PAGE.format(i=i, x="") for i in range(30)]
    w = html.learn(pages)
    assert html.main_text(pages[3], w) == "Title 3 One & two three four five six"
    extra = ("<aside>side bar</aside><form><input> send</form><div class='comments'><p>reader says so</p></div>"
             "<script>if (a < b) x('</p>')</script><p>last</p>")
    assert html.main_text(PAGE.format(i=1, x=extra), w).endswith("five six last")
    assert html.main_text("plain &lt;b&gt; text", w) == "plain <b> text"
    rows = [(1, pages[0], "t"), (2, None, "t"), (3, "", "t"), (4, "<p>" + "word " * 100_000 + "</p>", "t"),
            (1, pages[0], "t"), (5, "<nav>only a menu</nav>", "t"), (6, "<p <<>> unclosed <b", "t")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = {}
    for r in html.extract(df, html.train(df, "html", "page_id")).select("__row.page_id", "text").collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[2] == got[3] == got[5] == [""] and len(got[1]) == 2 and len(got[4][0]) == 499_999
    assert html.extract(df.limit(0), w).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("__row", F.lit(1)).withColumn("slot", F.lit("x"))
    before, columns = docs, docs.columns
    for i, (name, stage) in enumerate(p.STAGES):
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if i < 4:
            assert out.columns == columns
        if name == "near_dedup":
            brute = _brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], words=5)
            assert {r.doc_id for r in out.collect()} == {c if n else d for d, n, c in brute}
        if i < 3:
            assert out.count() <= docs.count() and out.join(before, "doc_id", "left_anti").count() == 0
        if name == "shard":
            assert {"shard", "slot"} <= set(out.columns) and out.count() == docs.count()
        docs = out
