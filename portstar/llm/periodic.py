r"""Periodic runs of words by internal pattern matching.

A text's words are ``[^\x20\x09-\x0D]+``. A run is a stretch of words with smallest period q that
cannot be extended, of at least ``max(LEAST_WORDS, LEAST_POWER * q)`` words: something is repeated
``LEAST_POWER`` times or more. :func:`collapse` drops from every run all but its first q words.

How the runs of a text are found (the texts of a batch are laid end to end and searched together; no
match crosses from one to the next, as a word's number depends on its text):

1. Prefix doubling ranks all blocks of 1, 2, 4, ... words, in texts up to half the longest text. Only
   blocks that occur again are refined further, so ordinary prose is done after a few steps. The last
   ranks give the suffix array of the places whose block of two words recurs.
2. A wavelet matrix over that suffix array answers range successor queries: the nearest place above
   (below) a given one at which the same block occurs.
3. For each block size b = 2^k the blocks at multiples of b are the patterns. A run with period q in
   [b/2, b) is at least 4q words long, so it contains one of them, and the block's next or previous
   occurrence inside the run, in the window of b words beside it, is exactly q away. So the gap to
   the nearest occurrence (the difference of the progression of occurrences in that window) is the
   candidate period.
4. A candidate is extended to both sides by descending through the ranks (equal ranks are equal
   blocks, with no hashes to collide) and kept where it is long enough. A kept candidate's period is
   the smallest one: with a smaller one the nearest occurrence would have been nearer.

Everything is array work over n words and log(n) block sizes. A task holds about ``BATCH_WORDS`` words,
or one text, at a time; no text is cut.

Defined results. Null or empty text: no words, no runs, the empty string. Repeated rows get equal
results; rows with a null id too. Extra columns travel along whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import packed, table

LEAST_WORDS, LEAST_POWER = 6, 4
BATCH_WORDS = 1 << 17
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _first_ranks(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of single words (places before the first equal one, in sorted order), and the places of
    words that occur again, in that order."""
    order = np.argsort(numbers, kind="stable")
    starts, again = _groups(numbers[order])
    ranks = np.empty(len(numbers), dtype=np.int64)
    ranks[order] = starts
    return ranks, order[again]


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: the index of the first equal key, and whether a key occurs more than once."""
    n = len(keys)
    fresh = np.ones(n + 1, dtype=bool)
    fresh[1:n] = keys[1:] != keys[:-1]
    starts = np.maximum.accumulate(np.where(fresh[:n], np.arange(n), 0)) if n else np.zeros(0, dtype=np.int64)
    return starts, ~(fresh[:n] & fresh[1:])


def block_ranks(numbers: np.ndarray, longest: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ranks of all blocks of 1, 2, 4, ... words up to half of ``longest``, and for each size the
    places of blocks that occur again. Equal ranks of one size are equal blocks."""
    n = len(numbers)
    ranks, recurring = _first_ranks(numbers)
    levels, places = [ranks], [recurring]
    size = 1
    while len(recurring) and 4 * size <= longest:
        old = ranks[recurring]                                   # ascending
        after = recurring + size                                 # only one block can end at the end
        key = old * (n + 1) + np.where(after < n, ranks[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        starts, again = _groups(key[order])
        parents, _ = _groups(old)
        ranks = ranks.copy()
        recurring = recurring[order]
        ranks[recurring] = old + (starts - parents)
        recurring = recurring[again]
        levels.append(ranks)
        places.append(recurring)
        size *= 2
    return levels, places


class WaveletMatrix:
    """A sequence of numbers below 2^bits; counts and order statistics of many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros, self.before = [], []
        for b in reversed(range(self.bits)):
            one = ((values >> b) & 1).astype(bool)
            before = np.zeros(len(values) + 1, dtype=np.int32)       # zero bits before each place
            np.cumsum(~one, out=before[1:])
            self.before.append(before)
            self.zeros.append(int(before[-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [low, high) are smaller than x."""
        count = np.zeros(len(x), dtype=np.int64)
        for b, before, zeros in zip(reversed(range(self.bits)), self.before, self.zeros):
            one = ((x >> b) & 1).astype(bool)
            l0, h0 = before[low], before[high]
            count += np.where(one, h0 - l0, 0)
            low = np.where(one, zeros + low - l0, l0)
            high = np.where(one, zeros + high - h0, h0)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) of [low, high)."""
        value = np.zeros(len(k), dtype=np.int64)
        for b, before, zeros in zip(reversed(range(self.bits)), self.before, self.zeros):
            l0, h0 = before[low], before[high]
            one = k >= h0 - l0
            k = np.where(one, k - (h0 - l0), k)
            low = np.where(one, zeros + low - l0, l0)
            high = np.where(one, zeros + high - h0, h0)
            value += np.where(one, 1 << b, 0)
        return value

    def neighbours(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range predecessor and successor of x, itself a value of [low, high); -1 where there is none."""
        at = self.below(low, high, x)
        out = []
        for k in (at - 1, at + 1):
            there = (k >= 0) & (k < high - low)
            value = np.full(len(x), -1, dtype=np.int64)
            value[there] = self.nth(low[there], high[there], k[there])
            out.append(value)
        return out[0], out[1]


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Words in common from places a and b on (step 1), or up to but not including them (step -1)."""
    n, total = len(levels[0]), np.zeros(len(a), dtype=np.int64)
    live = np.arange(len(a))                       # at the top size as often as needed, then once each
    for k in [len(levels) - 1] + list(reversed(range(len(levels)))):
        size, ranks = 1 << k, levels[k]
        again = k == len(levels) - 1
        rows = live
        while len(rows):
            x, y = (a[rows] + total[rows], b[rows] + total[rows]) if step > 0 else \
                (a[rows] - total[rows] - size, b[rows] - total[rows] - size)
            inside = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < n)
            rows, x, y = rows[inside], x[inside], y[inside]
            rows = rows[ranks[x] == ranks[y]]
            total[rows] += size
            if not again:
                break
    return total


def find_runs(numbers: np.ndarray, longest: int) -> np.ndarray:
    """Rows ``start, length, period`` of all runs of a sequence, by start and then period. ``longest``
    bounds the length of a run."""
    none = np.zeros((0, 3), dtype=np.int64)
    levels, places = block_ranks(numbers, longest)
    if len(levels) < 2 or not len(places[1]):
        return none
    again = places[1]
    suffixes = again[np.argsort(levels[-1][again], kind="stable")]
    matrix = WaveletMatrix(suffixes)
    firsts, gaps = [], []
    for k in range(1, len(levels)):
        size = 1 << k
        blocks = places[k][places[k] % size == 0]
        if not len(blocks):
            continue
        in_order = levels[k][suffixes]                           # ascending: every block is one range
        rank = levels[k][blocks]
        left, right = matrix.neighbours(np.searchsorted(in_order, rank, "left"),
                                        np.searchsorted(in_order, rank, "right"), blocks)
        for first, second, there in ((left, blocks, left >= 0), (blocks, right, right >= 0)):
            gap = second - first
            fits = there & (2 * gap >= size) & (gap < size)
            firsts.append(first[fits])
            gaps.append(gap[fits])
    if not firsts:
        return none
    first, gap = np.concatenate(firsts), np.concatenate(gaps)
    back = _common(levels, first, first + gap, -1)
    start, length = first - back, back + _common(levels, first, first + gap, 1) + gap
    found = np.stack([start, length, gap], axis=1)[length >= np.maximum(LEAST_WORDS, LEAST_POWER * gap)]
    found = found[np.lexsort((found[:, 1], found[:, 2], found[:, 0]))]
    keep = np.ones(len(found), dtype=bool)
    keep[1:] = (found[1:] != found[:-1]).any(axis=1)
    return found[keep]


def _search(texts: list[list[str]]) -> list[tuple[np.ndarray, str]]:
    """Runs of each text's words, and the words joined without the repetitions."""
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    words = [w for t in texts for w in t]
    which, names = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, dtype=np.int64), [])
    number = np.repeat(np.arange(len(texts)), sizes) * max(1, len(names)) + which
    runs = find_runs(number, int(sizes.max(initial=0)))
    kept = np.zeros(len(words) + 1, dtype=np.int64)              # how many runs drop a word, by differences
    np.add.at(kept, runs[:, 0] + runs[:, 2], 1)
    np.add.at(kept, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(kept) == 0
    of = np.searchsorted(runs[:, 0], np.concatenate([[0], ends]))
    out = []
    for i, t in enumerate(texts):
        at = ends[i] - sizes[i]
        mine = runs[of[i]:of[i + 1]]
        if len(mine):
            t = [w for w, k in zip(t, kept[at:ends[i]].tolist()) if k]
            mine = mine - [at, 0, 0]
        out.append((mine, " ".join(t)))
    return out


def analyse(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, str]]:
    """Words, runs and collapsed text of every text, in order."""
    batch, held = [], 0
    for t in texts:
        words = WORD.findall(t or "")
        if batch and held + len(words) > BATCH_WORDS:
            yield from ((len(w), *r) for w, r in zip(batch, _search(batch)))
            batch, held = [], 0
        batch.append(words)
        held += len(words)
    yield from ((len(w), *r) for w, r in zip(batch, _search(batch)))


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """``__row, n_words, runs, collapsed`` for every row of ``docs``; ``runs`` has ``start, length,
    period`` by start and then period."""
    @F.pandas_udf("n_words long, start array<long>, length array<long>, period array<long>, collapsed string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(n, r[:, 0], r[:, 1], r[:, 2], c) for n, r, c in analyse(list(b))],
                               columns=["n_words", "start", "length", "period", "collapsed"])

    d = packed(docs).withColumn("f", run(F.col(f"__row.`{text}`")))
    runs = F.arrays_zip(F.col("f.start").alias("start"), F.col("f.length").alias("length"),
                        F.col("f.period").alias("period"))
    return d.select("__row", F.col("f.n_words").alias("n_words"), runs.alias("runs"),
                    F.col("f.collapsed").alias("collapsed"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: a tenth of the texts, drawn by the id's CRC, repeat their words from a drawn
    place on; their words are then joined by one space."""
    h = F.crc32(F.col("doc_id").cast("string"))
    d = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"))
    d = d.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD.pattern})"), 1)))
    n = F.size("w").cast("long")
    d = d.withColumn("a", F.when(n > 0, F.col("g") % n))
    d = d.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    i = lambda place: F.when(place < F.col("a"), place).otherwise(
        F.col("a") + (place - F.col("a")) % F.col("p")).cast("int")
    moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda x: F.element_at("w", i(x) + 1))
    return d.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    done = collapse(with_planted_runs(table(spark, sf_dir, "documents", "doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n"))), "")
    d = done.select("__row.doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return d.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                    (-F.col("best.period")).alias("period"),
                    F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256")
