"""Main text of broken pages, leaks of personal data, and exact fingerprints, against brute force."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from portstar.llm import html, merkle, pii

SF = "/root/testdata/sf0.001"
KEY = b"k"
PLAIN = html.Weights()


# --- main text -----------------------------------------------------------------------------------

@pytest.mark.parametrize("page, text", [
    ("Head <p>before icon</p><svg/> <p>after icon words here</p>", "Head before icon after icon words here"),
    ("<p>a b</p><noscript>x y <p>after one</p>", "a b x y after one"),
    ("<p>a b</p><iframe src=x><p>after</p>", "a b after"),
    ("<p>a b</p><template><p>after</p>", "a b after"),
    ("<p>a b</p><svg viewBox='0 0'><p>after</p>", "a b after"),
    ("<p>a b</p><noscript>gone</noscript><p>after</p>", "a b after"),
    ("<p>a b</p><svg><svg>no</svg><text>no</text></svg><p>after</p>", "a b after"),
    ("<p>a</p><script>if (a < b) '</p>'</script><style>p {}</style><p>b</p>", "a b"),
    ("<p>a</p><title>t</p><p>b</p>", "a t b"),
    ("a < b and <3 c</p <b>x</b>", "a < b and <3 c x"),
    ("x <a title='1 > 0'>y</a> <a title=\"open>z</a>", "x y z"),
    ("t <!-- c > --> u <!--> v", "t u v"),
    ("<article><section class='discussion'><p>kept here</p></section><div id='search-results'>also</div>"
     "<div class='ad'>gone</div><div class='comments'>gone</div></article>", "kept here also"),
])
def test_page_text_is_kept_around_broken_and_embedded_elements(page, text):
    assert html.main_text(page, PLAIN) == text


def test_learned_content_beats_class_words():
    def page(i):
        body = " ".join(f"w{i}x{j}" for j in range(30))
        return (f"<nav>menu {i}</nav><article><h1>t {i}</h1><div class='sponsored story'><p>{body}</p></div>"
                f"<div class='ad'>buy</div></article>")
    weights = html.learn([page(i) for i in range(30)])
    assert "div.sponsored.story" in weights.content and "div.ad" not in weights.content
    assert html.main_text(page(99), weights).endswith("w99x29") and "buy" not in html.main_text(page(99), weights)
    few = html.learn([page(i) for i in range(5)])
    assert not few.content


@pytest.mark.parametrize("unit, tail", [
    ("<a ", ""), ("<a \"", ""), ("<a '>", ""), ("<svg>", ""), ("<noscript><p>x", ""), ("<!--", ""), ("</script ", ""),
    ("<title>", ""), ("<a x='", ">"), ("<p class=\"", ">"), ("<a b=\">\" '", ""), ("<div>", "</span>" * 150_000), ("<", ">")])
def test_two_megabyte_pages_take_linear_time(unit, tail):
    page = unit * (2_000_000 // len(unit)) + tail
    start = time.process_time()
    html.main_text(page, PLAIN)
    assert time.process_time() - start < 12


def _random_page(rng):
    tags = ["<p>", "</p>", "<b>", "</b>", "<div>", "</div>", "<nav>", "</nav>", "<div class=ad>", "<li>", "<br/>", "<svg/>"]
    return "".join(rng.choice(tags) if rng.random() < 0.6 else rng.choice(["one two ", "three ", "&amp; ", " "])
                   for _ in range(rng.randint(0, 25)))


def test_run_is_the_best_of_all_spans():
    rng = random.Random(6)
    for _ in range(300):
        page = _random_page(rng)
        scores, parts = html.scored(page, html.Weights({"p": -0.5, "div": -1.5, "/div": -1.5}))
        spans = [(i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        best = max((sum(scores[i:j]) for i, j in spans), default=0)
        i, j = html.best_run(scores)
        assert sum(scores[i:j]) == pytest.approx(max(best, 0))
        if best > 1e-9:
            same = [s for s in spans if abs(sum(scores[s[0]:s[1]]) - best) < 1e-9]
            assert j == min(e for _, e in same)


# --- pseudonyms ----------------------------------------------------------------------------------

def _swap(text):
    new, kinds = pii.replace_all(text, KEY)
    assert pii.reveal(new, KEY) == text and pii.replace_all(text, KEY) == (new, kinds)
    return new, kinds


@pytest.mark.parametrize("local", ["a.b.c.d.e.f.g.h.i.j.k.l.m.n", "q" * 70, "jürgen", "Иван.Петров", "o'brien", "王小明",
                                   "x" * 500 + "1", "ann+list", "İ.ſ.ß"])
def test_no_part_of_an_address_stays(local):
    new, kinds = _swap(f"to {local}@mail.example.org now")
    assert kinds == ["email"] and new.startswith("to ") and new.endswith("@mail.example.org now")
    swapped = new[3:-len("@mail.example.org now")]
    assert len(swapped) == len(local) and swapped != local
    assert [c.isalnum() for c in swapped] == [c.isalnum() for c in local]
    if len(local) > 20:
        assert local[:6] not in swapped                  # what used to stay in clear


@pytest.mark.parametrize("text, kind", [
    ("+33 1 23 45 67 89", "phone"), ("12/31/2020", "dmy"), ("1/2/2020", "dmy"), ("31.12.1999", "dmy"), ("9/11/2001", "dmy"),
    ("DE89 3704 0044 0532 0130 00", "iban"), ("GB82WEST12345698765432", "iban"), ("4111 1111 1111 1111", "number"),
    ("5500005555555559", "number"), ("+1 (269) 555-3296", "phone")])
def test_each_format_is_replaced_within_itself(text, kind):
    new, kinds = _swap(f"x {text} y")
    new = new[2:-2]
    assert kinds == [kind] and new != text
    assert re.sub("[0-9]", "0", re.sub("[A-Z]", "A", new)) == re.sub("[0-9]", "0", re.sub("[A-Z]", "A", text))
    if kind == "iban":
        flat = new.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1
    if kind == "number":
        assert pii.luhn(new.replace(" ", "")) and "2" <= new[0] <= "6"


@pytest.mark.parametrize("text", ["1699999999999", "002651439458202064", "1234567890123456", "30/30/2020", "2/30/2020",
                                  "DE88 3704 0044 0532 0130 00", "999.1.1.1", "@x.org", "a@b", "99999999999999999999"])
def test_what_does_not_validate_stays(text):
    assert _swap(text) == (text, [])


def test_cards_are_found_among_other_groups():
    for text in ["4451718024887799 27", "27 4451718024887799", "+1 (269) 555-3296 4524132264652876"]:
        new, kinds = _swap(text)
        assert "number" in kinds and "4451718024887799" not in new and "4524132264652876" not in new


def test_dates_permute_one_to_one_in_each_shape():
    p = pii.Permuter(KEY)
    for text in ["{}/{}/2020", "{:02d}/{:02d}/2020"]:
        days = [text.format(d, m) for m in range(1, 13) for d in range(1, 29)]
        swapped = [pii._dmy(p, s, False) for s in days]
        assert len(set(swapped)) == len(set(days)) and not set(zip(days, swapped)) & {(s, s) for s in days}


def test_random_texts_are_revealed_and_scanned_in_linear_time():
    rng = random.Random(1)
    pool = "0123456789 -./+()@abAB.com' é"
    for _ in range(8000):
        _swap("".join(rng.choice(pool) for _ in range(rng.randint(1, 60))))
    for text in ["a" * 200_000, "a" * 200_000 + "@x.com", "1 " * 100_000, "1" * 200_000, "a@" * 100_000,
                 "." * 200_000 + "@", "A1B2 " * 50_000, "1/" * 100_000]:
        start = time.process_time()
        _swap(text)
        assert time.process_time() - start < 30


def test_query_changes_found_values_only(spark):
    """Independent finders on the documents: every value they find is gone, all other text is equal."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = pii.query(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    mail = re.compile(r"[a-z0-9]+(?:\.[a-z0-9]+)*@(?:[a-z0-9]+\.)+[a-z]+")
    card = re.compile(r"(?<![0-9])[3-6][0-9]{15}(?![0-9])")
    phone = re.compile(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}")
    found = 0
    for r in rows:
        old = docs[r.doc_id] or ""
        values = [m for pat in (mail, phone) for m in pat.findall(old)] + [c for c in card.findall(old) if pii.luhn(c)]
        found += len(values)
        assert not [v for v in values if v in (r.text or "")]
        assert r.n_values >= len(set(values))
        assert pii.reveal(r.text or "", pii.DEMO_KEY) == old
        if not re.search("[0-9@]", old):
            assert (r.text or "") == old
    assert found > 3


# --- fingerprints --------------------------------------------------------------------------------

def _random_text(rng):
    return "".join(rng.choice("ab .!\n\tdé\U0001f600。") for _ in range(rng.randint(0, 300)))


def _dice(a, b):
    x, y = (Counter(re.split("[/;,]", f[33:])) for f in (a, b))
    return 2 * sum((x & y).values()) / (sum(x.values()) + sum(y.values()))


def test_pieces_add_up_and_roots_test_equality(spark):
    rng = random.Random(2)
    texts = ["", "One. Two. Three.", "One.  Two.\tThree.", "One. Two. Three. ", "a\nb", "a\nb\na\nb", "x" * 500, "x" * 501,
             "\n\n\n", "\n\n", "  ", "a. \t \t", "。" * 40] + [_random_text(rng) for _ in range(250)]
    texts += [t.replace(" ", "  ", 1) for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = merkle.fingerprints(df).withColumn("p", merkle.pieces(F.col("text"))).collect()
    assert all("".join(r.p) == r.text for r in rows)
    assert max(len(x) for r in rows for x in r.p) <= merkle.MOST + 9
    by_text = {r.text: r.fingerprint for r in rows}
    assert len({f[:32] for f in by_text.values()}) == len(by_text)
    assert all(r.fingerprint == by_text[r.text] for r in rows)


def test_likeness_counts_leaves_as_often_as_they_occur(spark):
    rng = random.Random(3)
    lines = [f"line {i}\n" for i in range(4)]
    pairs = [("a\nb", "a\nb\na\nb"), ("", ""), ("", "a"), ("same\n" * 5, "same\n" * 2)]
    pairs += [tuple("".join(rng.choice(lines) for _ in range(rng.randint(0, 12))) for _ in range(2)) for _ in range(120)]
    df = merkle.fingerprints(merkle.fingerprints(spark.createDataFrame(pairs, "a string, b string"), "a", "x"), "b", "y")
    got = df.select("a", "b", "x", "y", merkle.likeness(F.col("x"), F.col("y")).alias("l")).collect()
    for r in got:
        assert r.l == pytest.approx(_dice(r.x, r.y))
    assert got[0].l < 1 and got[1].l == 1 and got[2].l == 0


def test_an_insertion_moves_few_leaves_of_a_text_without_sentences(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    text = " ".join(words)
    df = spark.createDataFrame([(text, "inserted " + text)], "a string, b string")
    df = merkle.fingerprints(merkle.fingerprints(df, "a", "x"), "b", "y")
    assert df.select(merkle.likeness(F.col("x"), F.col("y")).alias("l")).first().l > 0.9


def test_fingerprint_query_against_brute_force(spark, monkeypatch):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    real = merkle.with_next
    monkeypatch.setattr(merkle, "with_next", lambda d: real(d, rows_per_range=7))
    monkeypatch.setattr(merkle, "_STRIDE", 3)
    rows = {r.doc_id: r for r in merkle.query(spark, SF).collect()}
    ids = sorted(docs)
    assert sorted(rows) == ids
    for i, j in zip(ids, ids[1:] + ids[:1]):
        r, n = rows[i], len(docs[i])
        edited = docs[i][:n - n // 2] + docs[j][:n // 2]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(_dice(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(_dice(r.fingerprint, rows[j].fingerprint))
        assert n < 200 or r.near_edited > 0
    same = Counter(docs.values())
    assert len({r.fingerprint for r in rows.values()}) == len(same)
