r"""Fill-in-the-middle transformation with an indexable skip list.

A text is cut into units, ``[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+`` from left to right:
a word with the white space before it, or white space at the end. The prefix ends after one drawn
number of units and the middle after another; the rest is the suffix.

The cuts are found in an indexable skip list over the units. Every node of every lane carries the
units and the code points up to the next node of its lane; lane 0 has one node a unit, and each
express lane keeps a node of the lane below with probability 1/4 (decided by a hash of its place, so
that a text always gets one list). Descending from the topmost lane and adding up widths reaches a
rank in O(log n) steps and yields its code-point offset: no offset is stored anywhere.

The prompt is ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle`` (spm). A text
that is empty or holds one of the three marks stays as it is (plain), so marks in an output are always
real ones and :func:`restored` takes the exact text back from output and form.

Defined results. Null text: the empty text, plain, no units. Very long texts are scanned whole, in
pieces of ``PIECE`` code points. A null id draws as the empty string. Repeated rows draw equal cuts.
Equal ranks give an empty middle. Extra columns travel along whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import packed, table

SEED = "42"
FIM_PERCENT, SPM_PERCENT = 50, 80
MARKS = ("<P>", "<S>", "<M>")
PIECE = 1 << 20
TOP = 8                        # the topmost lane has at most so many nodes


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit of ``text``, in order."""
    if not text:
        return np.zeros(0, dtype=np.int64)
    white = np.empty(len(text), dtype=bool)
    for at in range(0, len(text), PIECE):
        c = np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        white[at:at + len(c)] = (c == 0x20) | ((c >= 0x09) & (c <= 0x0D))
    ends = np.flatnonzero(white[1:] & ~white[:-1]) + 1       # a word ends where white space begins
    return np.diff(ends, prepend=0, append=len(text))


def _kept(n: int, lane: int) -> np.ndarray:
    """Places of a lane's nodes that the next lane keeps: the first, and a quarter of the others."""
    x = np.arange(n, dtype=np.uint64) + np.uint64((lane + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    kept = (x >> np.uint64(62)) == 0
    kept[0] = True
    return np.flatnonzero(kept)


class SkipList:
    """Lanes of ``(units, chars, below)``: the widths of each node, and its place in the lane below."""

    def __init__(self, widths: np.ndarray):
        self.size = len(widths)
        units, chars = np.ones(len(widths), dtype=np.int64), np.asarray(widths, dtype=np.int64)
        self.lanes = [(units, chars, np.arange(len(widths)))]
        while len(units) > TOP:
            kept = _kept(len(units), len(self.lanes))
            if len(kept) == len(units):
                break
            units, chars = np.add.reduceat(units, kept), np.add.reduceat(chars, kept)
            self.lanes.append((units, chars, kept))

    def offset(self, rank: int) -> int:
        """Code points before the unit of this rank (0..size)."""
        node, passed, points = 0, 0, 0
        for units, chars, below in reversed(self.lanes):
            n = len(units)
            while node < n and passed + units[node] <= rank:
                passed += int(units[node])
                points += int(chars[node])
                node += 1
            if passed == rank or node == n:       # reached, or the end of the list
                break
            node = int(below[node])
        return points


def cuts(text: str | None, a: int | None, b: int | None) -> tuple[int, int | None, int | None]:
    """Units of the text, and code points of prefix and middle for the draws ``a`` and ``b`` (taken
    modulo units + 1); none without draws."""
    widths = unit_widths(text or "")
    n = len(widths)
    if a is None or b is None:
        return n, None, None
    first, second = sorted((a % (n + 1), b % (n + 1)))
    units = SkipList(widths)
    start = units.offset(first)
    return n, start, units.offset(second) - start


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:id``."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text behind an output of the given form."""
    p, s, m = MARKS

    def between(start: str, stop: str | None) -> Column:
        at = F.instr(output, start) + len(start)
        return F.substring(output, at, (F.instr(output, stop) if stop else F.char_length(output) + 1) - at)

    middle = between(m, None)
    return (F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
            .when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output))


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``__row, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``."""
    @F.pandas_udf("n long, prefix_chars long, middle_chars long")
    def cut(texts: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        done = [cuts(t, None if pd.isna(x) else int(x), None if pd.isna(y) else int(y))
                for t, x, y in zip(texts, a, b)]
        return pd.DataFrame(done, columns=["n", "prefix_chars", "middle_chars"]).astype("Int64")

    t = F.coalesce(F.col(f"__row.`{text}`"), F.lit(""))
    a, b, c, d = draws(F.col(f"__row.`{doc_id}`"), seed)
    plain = (t == "") | (c % 100 >= fim_percent)
    for mark in MARKS:
        plain = plain | t.contains(mark)
    rows = packed(docs).select("__row", t.alias("t"), F.when(plain, "plain").when(
        d % 100 < spm_percent, "spm").otherwise("psm").alias("form"), a.alias("a"), b.alias("b"))
    drawn = F.col("form") != "plain"
    rows = rows.withColumn("c", cut("t", F.when(drawn, F.col("a")), F.when(drawn, F.col("b"))))
    start, middle = F.col("c.prefix_chars").cast("int"), F.col("c.middle_chars").cast("int")
    prefix = F.substring(F.col("t"), F.lit(1), start)
    mid = F.substring(F.col("t"), start + 1, middle)
    suffix = F.substring(F.col("t"), start + middle + 1, F.char_length("t"))
    p, s, m = (F.lit(x) for x in MARKS)
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, mid)).when(
        F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, mid)).otherwise(F.col("t"))
    return rows.select("__row", F.col("c.n").alias("n"), "form", F.col("c.prefix_chars").alias("prefix_chars"),
                       F.col("c.middle_chars").alias("middle_chars"), output.alias("output"))


def query(spark, sf_dir: str) -> DataFrame:
    done = transform(table(spark, sf_dir, "documents", "doc_id", "text"))
    return done.select(
        "__row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id::VARCHAR) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), r AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), f AS (
  SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
    u[1:least(h1 % (n + 1), h2 % (n + 1))] AS p,
    u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))] AS m,
    u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:] AS s FROM r
), g AS (
  SELECT doc_id, t, n, form, array_to_string(p, '') AS p, array_to_string(m, '') AS m,
    array_to_string(s, '') AS s FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(coalesce(p, '')) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(coalesce(m, '')) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || coalesce(p, '') || '<S>' || coalesce(s, '') || '<M>' || coalesce(m, '')
    ELSE '<S>' || coalesce(s, '') || '<P>' || coalesce(p, '') || '<M>' || coalesce(m, '') END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM g
"""
