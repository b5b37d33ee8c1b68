"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary labelled text. Both end
alike in the commonest words of ordinary text; in front of those stand the pieces of words that are
markedly more frequent in that class than in the other. A text is cut into windows of a few words
and each window is compressed with either dictionary: where the toxic one saves bytes, the window
resembles toxic text. How often a text's windows save at least t bytes, for several thresholds t,
against the rate of ordinary text, is calibrated into a probability by a logistic model.

The classifier is fitted on a bounded sample: the ``MAX_FIT_DOCS`` labelled documents of each class
that come first by a hash of their id, texts of up to ``MAX_FIT_CHARS`` code points. Scoring reads
every whole text. Only the text enters a score.

Defined results. Null or empty text: the score of a text without windows (the calibration's
value there). No toxic or no ordinary labels: every score is the share of toxic labels, 0 without
labels. Labels that are null are ignored; an id labelled both ways counts as toxic; labels without
a document are ignored. Repeated rows are scored alike. Null id: scored, not held out. Empty table:
no rows. Extra columns travel along whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import cut, packed, table

MAX_FIT_DOCS = 1500            # per class
MAX_FIT_CHARS = 20_000
WORDS = 4                      # per window
THRESHOLDS = (1, 2, 3, 4, 5, 6, 8)
PIECE_BYTES = 3000
BASE_WORDS = 600
SMOOTH = 25.0                  # pseudo-windows of ordinary text in a rate
HELD_OUT_EVERY = 5

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _pieces(word: str) -> set[str]:
    """The starts and ends, from four characters on, of a word with a space on either side."""
    s = f" {word[:24]} "
    return {s[:k] for k in range(4, len(s) + 1)} | {s[-k:] for k in range(4, len(s))}


class _ClassCounts:
    """Of each word: documents, and occurrences (at most three a document); then of the pieces."""

    def __init__(self, docs: list[list[str]]):
        words, within, self.words = Counter(), Counter(), 1
        for d in docs:
            c = Counter(d)
            within.update(c.keys())
            words.update({w: min(n, 3) for w, n in c.items()})
            self.words += len(d)
        self.n, self.docs = Counter(), Counter()
        for w, n in words.items():
            for g in _pieces(w):
                self.n[g] += n
                self.docs[g] += within[w]


def _marked(own: _ClassCounts, other: _ClassCounts, least_docs: int) -> list[str]:
    """Pieces markedly more frequent in ``own``: the most significant first (log-likelihood, in
    steps of a fifth), of those the longest, none that an earlier one contains."""
    found = []
    share = own.words / (own.words + other.words)
    for g, x in own.n.items():
        if own.docs[g] < least_docs:
            continue
        y = other.n[g]
        if math.log((x + 0.5) / own.words) - math.log((y + 0.5) / other.words) < 1.5:
            continue
        e, f = (x + y) * share, (x + y) * (1 - share)
        z = 2 * (x * math.log(x / e) + (y * math.log(y / f) if y else 0.0))
        if z >= 25:
            found.append((-round(math.log(z) * 5), -len(g), g))
    out, have, size = [], "", 0
    for _, _, g in sorted(found):
        if g not in have:
            out.append(g)
            have += g + "\n"
            size += len(g.encode())
            if size > PIECE_BYTES:
                break
    return out


@dataclass
class Dictionaries:
    """The contents of the two trained dictionaries and the text put before each window."""
    toxic: bytes
    ordinary: bytes
    lead: bytes

    @staticmethod
    def train(toxic: list[list[str]], ordinary: list[list[str]]) -> Dictionaries:
        t, o = _ClassCounts(toxic), _ClassCounts(ordinary)
        of_toxic = _marked(t, o, max(3, min(8, len(toxic) // 40)))
        of_ordinary = _marked(o, t, max(3, min(8, len(ordinary) // 40)))
        common: Counter = Counter()
        for d in ordinary:
            common.update(d)
        shared = []                    # no word that holds a piece of either class
        for w, _ in sorted(common.items(), key=lambda x: (-x[1], x[0])):
            if not any(g in f" {w} " for g in (*of_toxic, *of_ordinary)):
                shared.append(w)
            if len(shared) == BASE_WORDS:
                break
        base = "".join(" " + w for w in reversed(shared)) + " the end of words "
        contents = ["".join(reversed(pieces)) + base for pieces in (of_toxic, of_ordinary)]
        return Dictionaries(contents[0].encode(), contents[1].encode(), base[-24:].encode())

    def compressors(self):
        params = zstandard.ZstdCompressionParameters(
            window_log=14, chain_log=13, hash_log=12, search_log=5, min_match=4, target_length=24,
            strategy=zstandard.STRATEGY_LAZY, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=0, write_checksum=0, write_dict_id=0)
        made = []
        for content in (self.ordinary, self.toxic):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
        return made


def savings(words: list[str], lead: bytes, by_ordinary, by_toxic) -> list[int]:
    """Bytes that the toxic dictionary saves over the ordinary one, window by window."""
    out = []
    for i in range(0, len(words), WORDS):
        window = lead + " ".join(words[i:i + WORDS]).encode("utf-8", "replace") + b" "
        out.append(len(by_ordinary(window)) - len(by_toxic(window)))
    return out


def _counts(words: list[str], lead: bytes, by_ordinary, by_toxic) -> np.ndarray:
    """Windows, then windows that save at least each threshold."""
    d = np.array(savings(words, lead, by_ordinary, by_toxic), dtype=np.int64)
    return np.array([len(d), *[(d >= t).sum() for t in THRESHOLDS]], dtype=np.float64)


@dataclass
class Model:
    share: float
    dictionaries: Dictionaries | None = None
    rates: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def features(self, counts: np.ndarray) -> np.ndarray:
        n, k = counts[:, :1], counts[:, 1:]
        lift = np.log((k + SMOOTH * self.rates) / ((n + SMOOTH) * self.rates))
        size = np.log1p(n)
        return np.hstack([np.ones_like(n), lift, lift ** 2, np.minimum(k, 3), k >= 1, size, size ** 2])

    def scorer(self):
        if self.dictionaries is None:
            return lambda texts: np.full(len(texts), self.share)
        a, b = (c.compress for c in self.dictionaries.compressors())
        lead = self.dictionaries.lead

        def score(texts) -> np.ndarray:
            if not len(texts):
                return np.zeros(0)
            c = np.array([_counts(words_of(t), lead, a, b) for t in texts])
            z = np.clip(self.features(c) @ self.weights, -30, 30)
            return 1 / (1 + np.exp(-z))

        return score


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps; the intercept is not shrunk."""
    beta = np.zeros(x.shape[1])
    pen = np.full(x.shape[1], ridge)
    pen[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (w * (y - p)) - pen * beta
        h = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(pen)
        step = np.linalg.solve(h, g)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(sample: list[tuple[str | None, int]], n_toxic: int, n_ordinary: int) -> Model:
    """Dictionaries and calibration from labelled texts. The calibration sees window counts under
    dictionaries trained on the other half only; ``n_toxic`` and ``n_ordinary`` (the numbers of all
    usable labels) undo the sample's balance of classes."""
    share = n_toxic / max(1, n_toxic + n_ordinary)
    seen, docs = set(), []
    for text, y in sample:
        if (text, y) not in seen:
            seen.add((text, y))
            docs.append((words_of(text), y))
    toxic, ordinary = [d for d, y in docs if y], [d for d, y in docs if not y]
    if len(toxic) < 4 or len(ordinary) < 4:
        return Model(share)
    counts, labels = [], []
    for half in (0, 1):
        dic = Dictionaries.train(toxic[half::2], ordinary[half::2])
        a, b = (c.compress for c in dic.compressors())
        for y, group in ((1, toxic), (0, ordinary)):
            for d in group[1 - half::2]:
                counts.append(_counts(d, dic.lead, a, b))
                labels.append(y)
    c, y = np.array(counts), np.array(labels, dtype=np.float64)
    o = c[y == 0]
    model = Model(share, Dictionaries.train(toxic, ordinary),
                  rates=(o[:, 1:].sum(0) + 0.5) / (o[:, 0].sum() + 1))
    w = np.where(y == 1, n_toxic / y.sum(), n_ordinary / (1 - y).sum())
    w *= len(y) / w.sum()
    model.weights = _logistic(model.features(c), y, w)
    return model


def held_out(doc_id: Column, every: int = HELD_OUT_EVERY) -> Column:
    """Rows kept out of the fit: crc32 of the id as text, modulo ``every``, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % every == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), held-out rows left aside."""
    usable = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                           & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y")))
    # Labels count, and are chosen, where there is a document for them.
    there = docs.groupBy("doc_id").agg(F.max(F.coalesce(F.char_length("text"), F.lit(0)) <= MAX_FIT_CHARS).alias("short"))
    usable = cut(usable.join(there, "doc_id"))
    totals = {r.y: r.n for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id")
    chosen = usable.where("y = 1 AND short").orderBy(order, "doc_id").limit(MAX_FIT_DOCS).unionAll(
        usable.where("y = 0 AND short").orderBy(order, "doc_id").limit(MAX_FIT_DOCS)).drop("short")
    rows = (docs.select("doc_id", "text").where(F.coalesce(F.char_length("text"), F.lit(0)) <= MAX_FIT_CHARS)
                .join(F.broadcast(chosen), "doc_id")      # at most 2 * MAX_FIT_DOCS ids
                .orderBy(order, "doc_id", "text").limit(4 * MAX_FIT_DOCS).collect())
    return fit([(r.text, r.y) for r in rows], totals.get(1, 0), totals.get(0, 0))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``__row, score`` for every row of ``docs``; only whole texts go to Python."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for texts in batches:
            yield pd.Series(scorer(texts.tolist()), index=texts.index)

    d = packed(docs)
    return d.select("__row", run(F.col(f"__row.`{text}`")).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return score(docs, model).select(
        F.col("__row.doc_id").alias("doc_id"), held_out(F.col("__row.doc_id")).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
