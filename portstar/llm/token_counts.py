r"""Token counts of a public tokenizer by a map-side two-tier lookup.

A byte-level BPE splits a text into pre-tokens by a fixed pattern and merges within each of them, so a
text's count is the sum of its pre-tokens' counts. Those come from two tiers, both in the worker, so
that no pre-token is ever shuffled:

1. a compact table of frequent pre-tokens with their counts, broadcast once: at most ``HOT`` pre-tokens
   of at most ``HOT_BYTES`` bytes (one block of bytes, their lengths, their counts), so at most
   ``HOT * (HOT_BYTES + 3)`` bytes at any size of corpus;
2. what is not in it is encoded by the tokenizer library, once for each worker: results stay in a cache
   of at most ``COLD`` pre-tokens, which outlives a task.

The frequent pre-tokens are those of ``FIT_DOCS`` texts of up to ``FIT_CHARS`` code points each, the
first by a hash of the text. They decide about speed only: every count is the library's.

The pattern here and the library's own need not agree on every character (other versions of Unicode).
So a worker tests each character when it first meets it: next to a letter, a digit and a sign both
must split alike. Texts with a character on which they differ go to the library whole. Special
strings of the tokenizer count as the library counts them: one token each, and pre-tokens do not
reach across them.

Defined results. Null or empty text: no bytes, no tokens. Very long texts and very long pre-tokens are
counted whole (long pre-tokens are not cached). Repeated rows get equal counts. Extra columns travel
along whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import packed, table

TOKENIZER = "byte_bpe_50k.json"
LIMIT_TOKENS = 1024
HOT, HOT_BYTES = 1 << 16, 60
COLD = 1 << 18
FIT_DOCS, FIT_CHARS = 1_000, 20_000

# Fixed value: the pattern that splits text before the merges of the tokenizer.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def tokenizer_text(path: str) -> str:
    """The tokenizer's file; it travels as text, so that executors need not see the path."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def pack(counts: dict[str, int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Compact form of the frequent table: bytes of all pre-tokens, their lengths, their counts."""
    raw = [p.encode("utf-8", "surrogatepass") for p in counts]
    return b"".join(raw), np.array([len(r) for r in raw], dtype=np.uint8), np.array(list(counts.values()), dtype=np.uint16)


def unpack(blob: bytes, sizes: np.ndarray, counts: np.ndarray) -> dict[str, int]:
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return {blob[e - s:e].decode("utf-8", "surrogatepass"): c
            for e, s, c in zip(ends, sizes.tolist(), counts.tolist())}


class Lengths(dict):
    """Tokens of a pre-token: the frequent ones, then a bounded cache, then the library."""

    def __init__(self, hot: dict[str, int], encode):
        super().__init__(hot)
        self.encode, self.cold = encode, {}

    def __missing__(self, piece: str) -> int:
        n = self.cold.get(piece)
        if n is None:
            n = len(self.encode(piece, add_special_tokens=False).ids)
            if len(piece) <= HOT_BYTES:
                if len(self.cold) >= COLD:
                    self.cold.clear()
                self.cold[piece] = n
        return n


class TokenCounter:
    """Counts of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, tokenizer: str, hot: dict[str, int] | None = None):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(tokenizer)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder().values()
        plain = all(not (a.lstrip or a.rstrip or a.single_word or a.normalized) for a in added)
        self.added = [a.content for a in added]
        # Strings that take white space with them, or match normalised text, are left to the library.
        self.split = regex.compile("|".join(sorted(map(regex.escape, self.added), key=len, reverse=True))) \
            if self.added and plain else None
        self.lengths = Lengths(hot or {}, self.library.encode)
        self.alike: set[str] = set()
        self.unlike: set[str] = set()
        self._test({chr(i) for i in range(128)})

    def _same(self, text: str) -> bool:
        theirs = [at for _, at in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return theirs == [m.span() for m in PATTERN.finditer(text)]

    def _test(self, chars: set[str]) -> None:
        """Sorts characters by whether both patterns split alike next to each kind of character."""
        def probe(c: str) -> str:
            return f"a{c}1{c}!{c} {c}  {c}"
        one_by_one = [] if self._same("a".join(map(probe, sorted(chars)))) else sorted(chars)
        bad = {c for c in one_by_one if not self._same(probe(c) + "a")}
        self.unlike |= bad
        self.alike |= chars - bad

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not text.isascii() or self.unlike:
            chars = set(text)
            new = chars - self.alike - self.unlike
            if new:
                self._test(new)
            if chars & self.unlike:
                return len(self.library.encode(text, add_special_tokens=False).ids)
        if any(a in text for a in self.added):
            if self.split is None:
                return len(self.library.encode(text, add_special_tokens=False).ids)
            parts = self.split.split(text)
            return len(parts) - 1 + sum(self._pieces(p) for p in parts)
        return self._pieces(text)

    def _pieces(self, text: str) -> int:
        return sum(map(self.lengths.__getitem__, PATTERN.findall(text)))


def frequent(docs: DataFrame, tokenizer: str, text: str = "text") -> dict[str, int]:
    """Tokens of the most frequent pre-tokens of a bounded sample of texts. The hashes are ranked
    first, alone, so that no task sends more texts to the driver than the sample holds."""
    usable = docs.where(F.char_length(text) <= FIT_CHARS).select(
        F.col(text).alias("t"), F.xxhash64(text).alias("o"))
    last = usable.select("o").distinct().orderBy("o").limit(FIT_DOCS).agg(F.max("o").alias("o")).first().o
    if last is None:
        return {}
    rows = usable.where(F.col("o") <= last).groupBy("o").agg(F.min("t").alias("t")).collect()
    seen = Counter()
    for r in rows:
        seen.update(PATTERN.findall(r.t))
    lengths = TokenCounter(tokenizer).lengths
    best = sorted((p for p in seen if len(p.encode("utf-8", "surrogatepass")) <= HOT_BYTES),
                  key=lambda p: (-seen[p], p))[:HOT]
    return {p: lengths[p] for p in best}


_COUNTERS: dict[str, TokenCounter] = {}      # one a worker process: its caches outlive a task


def _counter(tokenizer: str, hot: tuple) -> TokenCounter:
    name = hashlib.sha256(tokenizer.encode() + hot[0]).hexdigest()
    if name not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[name] = TokenCounter(tokenizer, unpack(*hot))
    return _COUNTERS[name]


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """``__row, n_bytes, n_tokens`` for every row of ``docs``."""
    tokenizer = tokenizer_text(tokenizer_path)
    sent = docs.sparkSession.sparkContext.broadcast((tokenizer, pack(frequent(docs, tokenizer, text))))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(*sent.value)
        for b in batches:
            yield pd.Series([counter.count(t) for t in b], index=b.index, dtype="int64")

    t = F.col(f"__row.`{text}`")
    return packed(docs).select("__row", F.coalesce(F.octet_length(t).cast("long"), F.lit(0).cast("long"))
                               .alias("n_bytes"), count(t).alias("n_tokens"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return count_tokens(docs, default_path()).select(
        "__row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT_TOKENS).alias("over_limit"))
