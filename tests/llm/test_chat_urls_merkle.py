"""Chat examples, URL filter and Merkle fingerprints against plain Python versions."""

import hashlib
import random

from pyspark.sql import functions as F

from portstar.llm import chat, merkle, urls

CONV = "conv_id long, turn long, role string, text string, full string, n int"


def _digest(turns):
    h = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), h, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def _conversations():
    rnd = random.Random(5)
    bits = ["\\", "</turn>", "###", "### Assistant:", ":\n", "\n", "x", "é😀", "<", "#", "\\\\", "/turn>", " "]
    rows = []
    for conv in range(40):
        for turn in range(rnd.randint(1, 7)):
            text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))
            role = rnd.choice(["user", "assistant", "system", "odd:\nrole</turn>"])
            rows.append((conv, turn, role, text, "clash", 1))
    rows += [(100, 0, "user", None, "a", 1), (100, 1, "assistant", None, "a", 1),
             (101, 0, None, "no role", "a", 1), (None, 0, "user", "null id", "a", 1),
             (102, 1, "assistant", "same", "a", 1), (102, 1, "assistant", "same", "a", 1),
             (103, None, "assistant", "null turn", "a", 1), (103, 0, "user", "later", "a", 1),
             (104, 0, "assistant", "long " * 20000, "a", 1)]
    return rows


def test_prefix_targets_round_trip(spark):
    rows = _conversations()
    got = chat.conversation_digest(chat.expand_prefix_targets(spark.createDataFrame(rows, CONV))).collect()
    want = {}
    for c, turn, r, t, *_ in rows:
        want.setdefault(c, []).append((-1 if turn is None else turn, r or "", t or ""))
    assert len(got) == len(want)
    for g in got:
        turns = [(r, t) for _, r, t in sorted(want[g.conv_id])]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == _digest(turns), g.conv_id


def test_prefix_targets_examples(spark):
    rows = [(1, 0, "user", "q", "", 1), (1, 1, "assistant", "a", "", 1), (1, 2, "user", "q2", "", 1),
            (1, 3, "assistant", "a2", "", 1), (1, 4, "user", "bye", "", 1)]
    e = {r.example: r for r in chat.expand_prefix_targets(spark.createDataFrame(rows, CONV)).collect()}
    assert sorted(e) == [1, 2, 3]
    assert e[1].text == "### user:\nq</turn>\n### assistant:\na</turn>\n"
    assert e[2].text.startswith(e[1].text) and e[3].text.startswith(e[2].text)
    assert [e[i].text[e[i].loss_start:e[i].loss_start + e[i].loss_length] for i in (1, 2, 3)] == ["a", "a2", ""]
    assert [e[i].whole for i in (1, 2, 3)] == [False, False, True]


def test_prefix_targets_empty(spark):
    assert chat.conversation_digest(chat.expand_prefix_targets(spark.createDataFrame([], CONV))).count() == 0


def _verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    path = tail[:end]
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), h + p, v))
    return host, path, best[2] if best else None, best[3] if best else "allow"


def test_url_rules_against_brute_force(spark):
    rnd = random.Random(2)
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("a.net", "", "block"), ("org", "/x", "block")]
    rules += [(f"h{i}.org", f"/p{i}", "block") for i in range(300)]
    hosts = ["example.com", "WWW.Example.com", "a.net", "b.a.net", "net", "h7.org", "x.h299.org", "org", "", "ü.com"]
    paths = ["", "/", "/en/", "/en/1?x#y", "/es/2", "/p7", "/p299/z", "?q", "#f", "/x", "/xy", "/EN/"]
    rows = [(i, f"{rnd.choice(['http', 'https'])}://{rnd.choice(hosts)}{rnd.choice(paths)}", "h", "p")
            for i in range(400)]
    rows += [(900, None, "h", "p"), (901, "", "h", "p"), (902, "no scheme", "h", "p"), (903, "a://b://c/d", "h", "p"),
             (904, "http://a.net/" + "y" * 100_000, "h", "p")] + rows[:5]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, path string")
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = urls.judge(df, r).select("__row.page_id", "host", "path", "rule", "verdict").collect()
    want = sorted((i, *_verdict(u, rules)) for i, u, *_ in rows)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_url_filter_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r)[1:] for r in urls.judge(pages, none).collect()] == [("a.b", "/c", None, "allow")]
    assert urls.judge(pages.limit(0), none).count() == 0


def test_bloom_filter_never_drops_a_member_and_drops_most_others(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("h"))
    bloom = urls.bloom_blocks(keys, 128)
    assert urls.pass_bloom(keys, bloom, 128).count() == 2000
    others = spark.range(10_000, 30_000).select(F.xxhash64("id").alias("h"))
    assert urls.pass_bloom(others, bloom, 128).count() < 600


DOCS = "doc_id long, text string, range int, late string, ord long"


def test_fingerprints_of_neighbours(spark, monkeypatch):
    rnd = random.Random(3)
    text = lambda: "\n".join(" ".join(rnd.choice("abcdefgh") * 3 for _ in range(6)) + ". X y."
                             for _ in range(rnd.randint(0, 12)))
    rows = [(i * 3, text(), 1, "x", 2) for i in range(60)]
    rows += [(7, rows[4][1], 1, "x", 2), (200, None, 1, "x", 2), (201, "", 1, "x", 2), (None, "null id", 1, "x", 2),
             (202, "a" * 300_000, 1, "x", 2), (202, "tie", 1, "x", 2), (202, "tie", 1, "x", 2)]
    df = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(merkle, "table", lambda *a, **k: df.select("doc_id", "text"))
    monkeypatch.setattr(merkle, "_STRIDE", 4)
    real = merkle.with_next
    monkeypatch.setattr(merkle, "with_next", lambda d: real(d, rows_per_range=9))
    got = merkle.query(spark, "").collect()
    assert len(got) == len(rows)
    # ids ascending, null first; the tied rows of id 202 in any one order
    key = lambda r: (-1 if r[0] is None else r[0])
    order = sorted(rows, key=key)
    by_id = {}
    for g in got:
        by_id.setdefault(g.doc_id, []).append(g)
    for a, b in zip(order, order[1:] + order[:1]):
        if a[0] == 202 or b[0] == 202:
            continue
        s, nxt = a[1] or "", b[1] or ""
        half = len(s) // 2
        want = s[:len(s) - half] + nxt[:half]
        g = by_id[a[0]][0]
        assert (g.n_chars, g.edited_sha256) == (len(s), hashlib.sha256(want.encode()).hexdigest())
        assert g.near_next == 1.0 if s == nxt else 0 <= g.near_next < 1
        assert 0 <= g.near_edited <= 1
    assert by_id[7][0].fingerprint == next(g for g in got if g.doc_id == 12).fingerprint
    assert len({g.fingerprint for g in got}) == len({r[1] or "" for r in rows})


def test_changed_sections_locate_an_edit(spark):
    text = "\n".join(f"line {i} of it.\n" for i in range(20))
    df = spark.createDataFrame([(text, text.replace("line 7", "edited"))], "a string, b string")
    df = merkle.fingerprints(merkle.fingerprints(df, "a", "fa"), "b", "fb")
    r = df.select(merkle.changed_sections(F.col("fa"), F.col("fb")).alias("c"),
                  merkle.likeness(F.col("fa"), F.col("fb")).alias("l")).first()
    assert len(r.c) == 1 and 0.9 < r.l < 1


def test_single_and_no_document(spark, monkeypatch):
    one = spark.createDataFrame([(5, "only one. here")], "doc_id long, text string")
    monkeypatch.setattr(merkle, "table", lambda *a, **k: one)
    g = merkle.query(spark, "").first()
    assert g.near_next == 1.0
    monkeypatch.setattr(merkle, "table", lambda *a, **k: one.limit(0))
    assert merkle.query(spark, "").count() == 0
