"""Benchmark decontamination by template canonicalisation.

Texts become sequences of lower-case words in which numbers, names and units are typed
placeholders (``<num>``, ``<name>``, ``<unit>``), so that a question with other numbers or names
has the same template. A run of one placeholder within a sentence is one slot, so names of several
words stand for names of one. A capitalised word that starts a sentence is a word or a name: windows
that hold one are read both ways, in the benchmark and in the documents, and match in either reading.

All windows of ``WINDOW`` template tokens of the benchmark are hashed; the windows of all documents are
looked up and joined with them. Shorter items have shorter windows (:func:`_width`), so that one or two
edits leave windows between them; items shorter than ``WINDOW`` are matched as a whole. Windows with
fewer than ``MIN_WORDS`` ordinary words give no evidence as templates; they are looked up with their
literal values instead (unfolded), so that every item that has a token is found where it is copied
verbatim.

A window of more than ``SHARED`` different item texts (an instruction that many questions share) tells
nothing about which item it comes from. Such windows start no match: they are joined with a document
only for the items that another window found there, and an item's own windows have to reach the coverage
of its own part as well. Items that consist of shared windows only keep all of them.

A match lines an item up with a document at a shift (document position minus item position, in
tokens). Windows whose shifts lie within half of the item's length, or ``WINDOW`` tokens, are one
region, whatever was inserted, deleted or replaced between them. Within a region every slot value of
the item stands for the value of the document that most of its places show, and two values never
for the same one; windows that contradict this are left out. An item is found where the windows
that remain cover ``COVERAGE`` of its tokens.

Every window of every whole document is looked up: a bitmap of fixed size (``BITMAP_BITS``) of the
benchmark's window hashes is all that travels to the tasks; it drops nearly all windows and never a
benchmark window. What passes is joined with the benchmark's windows by an ordinary equi-join (any
size of benchmark, hot windows split by adaptive execution), which removes false positives.

Defined results. Null or empty texts match nothing, in either table. Very long texts are read whole.
Repeated rows are all reported. Item or document ids may be null. Equal items are all reported. Empty
tables: nothing found. Extra columns travel along in :func:`decontaminate` whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import cut, packed, table

WINDOW = 8
SHORT_WINDOWS = ((20, 4), (40, 5))   # items below so many template tokens, from 10 on, and their windows
SHARED = 16                    # item texts that may hold a window that starts matches
COVERAGE = 0.5
BITMAP_BITS = 1 << 23
MAX_BROADCAST_ROWS = 1_000_000   # 8-byte row keys
PIECE = 1 << 18                # characters of texts that are read together
MIN_WORDS = 3                  # words that are not placeholders in an indexed window

_TOKEN = re.compile(r"[0-9]+(?:[.,:/][0-9]+)*|[^\W\d_]+|[.!?]")
# Unit words that become <unit> after a number.
UNITS = frozenset(
    "mm cm m km mg g kg t s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years ml l litre litres liter liters meter meters metre metres mile miles "
    "foot feet inch inches yard yards pound pounds ounce ounces gram grams kilogram kilograms ton "
    "tons dollar dollars euro euros cent cents percent degree degrees mph kmh kph hz khz mhz ghz w "
    "kw mw v volt volts watt watts joule joules newton newtons byte bytes kb mb gb tb".split())
# Number words that become <num>.
NUMBER_WORDS = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion".split())


ORDINARY, NUMBER, UNIT, NAME, STOP, NAMED_UNIT = range(6)      # kinds of words, apart from their place
_SLOT = ("", "<num>", "<name>", "<unit>")                        # kinds of template tokens


def _kind(word: str) -> int:
    low = word.lower()
    if word in ".!?":
        return STOP
    if word[0].isdigit() or low in NUMBER_WORDS:
        return NUMBER
    named = len(word) > 1 and word[0].isupper() and word[1:].islower()
    return (NAMED_UNIT if named else UNIT) if low in UNITS else NAME if named else ORDINARY


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token) & ~7


class _Vocabulary(dict):
    """64-bit numbers of words: a hash of the lower-case word over the three bits of its kind. Filled
    in as words come; emptied before it grows large."""

    LIMIT = 400_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = _hash(word.lower()) | _kind(word)
        return value


_SLOT_HASH = np.array([_hash(t) for t in _SLOT], dtype=np.uint64)


class Parsed:
    """The templates of some texts, laid end to end: for each token its text's number (``of``), its literal
    hash, its kind of slot (0: an ordinary word), and whether it is a capitalised word at the start of
    a sentence (``first``)."""

    def __init__(self, texts: Sequence[str | None], vocabulary: _Vocabulary):
        found = [_TOKEN.findall(t or "") for t in texts]
        self.raw = list(chain.from_iterable(found))
        codes = np.fromiter(map(vocabulary.__getitem__, self.raw), dtype=np.uint64, count=len(self.raw))
        of = np.repeat(np.arange(len(found)), [len(f) for f in found])
        kind = (codes & np.uint64(7)).astype(np.int8)
        self.at = np.flatnonzero(kind != STOP)                 # places in raw
        kind, self.of = kind[self.at], of[self.at]
        self.literal = codes[self.at] >> np.uint64(3) << np.uint64(3)
        start = np.ones(len(kind), dtype=bool)
        start[1:] = (np.diff(self.at) > 1) | (self.of[1:] != self.of[:-1])
        number = kind == NUMBER
        unit = np.zeros(len(kind), dtype=bool)
        unit[1:] = number[:-1] & ~start[1:] & ((kind[1:] == UNIT) | (kind[1:] == NAMED_UNIT))
        named = ((kind == NAME) | (kind == NAMED_UNIT)) & ~unit
        self.start, self.first = start, named & start
        self.slot = np.where(number, 1, np.where(named & ~start, 2, np.where(unit, 3, 0)))
        self.begins = np.searchsorted(self.of, np.arange(len(found)))    # each text's first token

    def __len__(self) -> int:
        return len(self.at)

    def value(self, i: int, j: int) -> str:
        """The words of the tokens i up to j, in lower case."""
        return " ".join(self.raw[k].lower() for k in self.at[i:j])

    def reading(self, names_first: bool) -> Reading:
        slot = np.where(self.first, 2, self.slot) if names_first else self.slot
        again = np.zeros(len(slot), dtype=bool)                # continues a run of one placeholder
        again[1:] = (slot[1:] > 0) & (slot[1:] == slot[:-1]) & ~self.start[1:]
        starts = np.flatnonzero(~again)
        slot = slot[starts]
        return Reading(self, self.of[starts], np.where(slot > 0, _SLOT_HASH[slot], self.literal[starts]), slot,
                       np.append(starts, len(again)), self.first[starts] if names_first else None)


@dataclass
class Reading:
    """Template tokens with each run of a placeholder as one slot: text, hash, kind, and where in all
    tokens each begins (and the end of all). ``first`` marks words read as names at a sentence start."""
    text: Parsed
    of: np.ndarray
    hashes: np.ndarray
    slot: np.ndarray
    starts: np.ndarray
    first: np.ndarray | None

    def windows(self, width: int) -> np.ndarray:
        """Whether the window at each place lies in one text and is of this reading only."""
        if not width or len(self.of) < width:
            return np.zeros(0, dtype=bool)
        own = _within(self.of, width)
        if self.first is not None:
            seen = np.concatenate([[0], np.cumsum(self.first)])
            own &= seen[width:] > seen[:-width]
        return own

    def words(self, p: int, width: int) -> int:
        return int((self.slot[p:p + width] == 0).sum())

    def slots(self, p: int, width: int) -> list[str]:
        """``kind|value`` of each placeholder of a window, in order."""
        return [f"{_SLOT[self.slot[i]]}|{self.text.value(self.starts[i], self.starts[i + 1])}"
                for i in range(p, p + width) if self.slot[i]]


def _within(of: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` tokens, whether it lies in one text."""
    return of[:len(of) - width + 1] == of[width - 1:]


def template(text: str | None) -> tuple[list[str], list[str]]:
    """Template tokens and the values that stand behind them.

    A name is a capitalised word that neither starts a sentence nor stands among capitals only.
    """
    p = Parsed([text], _Vocabulary())
    values = [p.raw[i].lower() for i in p.at]
    return [_SLOT[k] or v for k, v in zip(p.slot.tolist(), values)], values


def _width(n: int) -> int:
    """Window length of an item of ``n`` template tokens."""
    if n < WINDOW + 2:
        return min(n, WINDOW)
    return next((width for below, width in SHORT_WINDOWS if n < below), WINDOW)


_MULTIPLIER = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_MULTIPLIER, WINDOW - 1 - j, 1 << 64) for j in range(WINDOW)], dtype=np.uint64)
_LITERAL = np.uint64(0x5851F42D4C957F2D)      # sets hashes of values apart from those of templates


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_hashes(x: np.ndarray, widths: Sequence[int], literal: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the ascending ``widths``, at most ``WINDOW``, the hashes (int64) of all windows of so
    many token numbers; none if there are fewer."""
    total, n, done = np.zeros(len(x), dtype=np.uint64), len(x), 0
    for width in widths:
        if not width or n < width:
            yield width, np.zeros(0, dtype=np.int64)
            continue
        for j in range(done, width):
            total = total[:n - j] + x[j:] * _POWERS[j]
        done = width
        h = total + np.uint64(width)
        yield width, _mix(h ^ _LITERAL if literal else h).view(np.int64)


def item_windows(text: str | None, vocabulary: _Vocabulary) -> tuple[int, list[tuple]]:
    """The item's number of tokens and its ``literal, width, pos, span, h, slots, at``; ``pos`` and
    ``span`` are in unfolded tokens, ``at`` has the slots' positions."""
    parsed = Parsed([text], vocabulary)
    plain, out = parsed.reading(False), []
    n = len(plain.slot)
    for r in (plain, parsed.reading(True)):
        width = min(_width(n), len(r.slot))
        (_, hashes), = window_hashes(r.hashes, [width])
        for p in np.flatnonzero(r.windows(width)).tolist():
            if r.words(p, width) >= min(MIN_WORDS, width):
                at = [int(r.starts[i]) for i in range(p, p + width) if r.slot[i]]
                out.append((False, width, int(r.starts[p]), int(r.starts[p + width] - r.starts[p]), int(hashes[p]),
                            r.slots(p, width), at))
    width = min(len(parsed), WINDOW if n < WINDOW else _width(n))
    ordinary = parsed.slot == 0
    (_, hashes), = window_hashes(parsed.literal, [width], True)
    for p, h in enumerate(hashes.tolist()):
        if ordinary[p:p + width].sum() < min(MIN_WORDS, width):
            out.append((True, width, p, width, h, [], []))
    return len(parsed), out


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, item_row, n_tokens`` and :func:`item_windows` of every indexed window, with ``own``
    (few item texts hold it) and ``own_tokens``, the item's tokens that such windows cover."""
    schema = ("item_id long, item_row long, item_text long, n_tokens int, literal boolean, width int, b_pos int, "
              "span int, h long, b_slots array<string>, b_at array<int>")
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = _Vocabulary()
        for b in batches:
            out = []
            for i, row, text_row, t in zip(b["item_id"], b["item_row"], b["item_text"], b["text"]):
                n, windows = item_windows(t, vocabulary)
                out += [(i, row, text_row, n, *w) for w in windows]
            yield pd.DataFrame(out, columns=columns).astype({"item_id": "Int64"})

    b = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    b = b.withColumns({"item_row": F.xxhash64("item_id", "text"), "item_text": F.xxhash64("text")})
    w = cut(b.dropDuplicates(["item_id", "text"]).mapInPandas(run, schema))
    shared = w.groupBy("h").agg(F.count_distinct("item_text").alias("texts")).where(F.col("texts") > SHARED)
    w = w.join(shared.select("h", F.lit(True).alias("shared")), "h", "left")
    # Positions of one item: a set bounded by its length.
    places = F.flatten(F.collect_set(F.when(F.col("shared").isNull(), F.sequence(
        F.col("b_pos"), F.col("b_pos") + F.col("span") - 1))))
    items = w.groupBy("item_row").agg(F.size(F.array_distinct(places)).alias("own_tokens"))
    w = w.join(items, "item_row")
    own = F.col("shared").isNull() | (F.col("own_tokens") == 0)
    return w.select("item_id", "item_row", "n_tokens", "literal", "width", "b_pos", "span", "h", "b_slots", "b_at",
                    own.alias("own"), F.when(F.col("own_tokens") > 0, F.col("own_tokens")).otherwise(
                        F.col("n_tokens")).alias("own_tokens"))


def bitmap(windows: DataFrame) -> bytes:
    """Bitmap of the window hashes: at most ``BITMAP_BITS`` bits however large the benchmark."""
    slot = F.pmod("h", F.lit(BITMAP_BITS).cast("long"))
    words = windows.groupBy(F.floor(slot / 64).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))).alias("b"))
    bits = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    for r in words.collect():                       # at most BITMAP_BITS / 64 rows
        bits[r.w] = r.b
    return bits.tobytes()


def document_windows(docs: DataFrame, bits: bytes, kinds: list[tuple[bool, int]]) -> DataFrame:
    """``doc_id, doc_row, pos, h, slots`` of the windows whose bit is set. ``docs`` has ``doc_id,
    doc_row, text``; ``kinds`` are the benchmark's ``literal, width``."""
    schema = "doc_id long, doc_row long, pos int, h long, slots array<string>"
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    widths = [width for literal, width in kinds if not literal]
    literals = [width for literal, width in kinds if literal]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = _Vocabulary()
        words = np.frombuffer(sent.value, dtype=np.uint64)

        def passed(h: np.ndarray, ok: np.ndarray) -> list[int]:
            slot = h.view(np.uint64) & np.uint64(BITMAP_BITS - 1)
            hit = (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)
            return np.flatnonzero(hit.astype(bool) & ok).tolist()

        def found(ids: list, rows: list, texts: list[str | None]) -> Iterator[tuple]:
            parsed = Parsed(texts, vocabulary)
            begins = parsed.begins

            def row(of: int, place: int, h: int, slots: list[str]) -> tuple:
                return ids[of], rows[of], place - int(begins[of]), h, slots

            for width, hs in window_hashes(parsed.literal, literals, True):
                for p in passed(hs, _within(parsed.of, width)) if len(hs) else ():
                    yield row(parsed.of[p], p, int(hs[p]), [])
            for names_first in (False, True) if widths else ():
                r = parsed.reading(names_first)
                for width, hs in window_hashes(r.hashes, widths):
                    for p in passed(hs, r.windows(width)) if len(hs) else ():
                        yield row(r.of[p], int(r.starts[p]), int(hs[p]), r.slots(p, width))

        for b in batches:
            sizes = b["text"].str.len().fillna(0).cumsum()      # some texts together, about PIECE characters
            for _, part in b.groupby((sizes // PIECE).to_numpy(), sort=False):
                out = list(found(part["doc_id"].tolist(), part["doc_row"].tolist(), part["text"].tolist()))
                yield pd.DataFrame(out, columns=["doc_id", "doc_row", "pos", "h", "slots"]).astype(
                    {"doc_id": "Int64", "doc_row": "int64"})

    return docs.mapInPandas(run, schema)


def _majority(windows: list) -> dict[str, str]:
    """The one-to-one map of slot values that most places show; at a tie the item's own value."""
    places = {x for w in windows for x in zip(w["b_at"], w["b_slots"], w["slots"])}
    votes, to, taken = Counter((b, d) for _, b, d in places), {}, set()
    for b, d in sorted(votes, key=lambda x: (-votes[x], x[0] != x[1], x)):
        if b not in to and d not in taken:
            to[b] = d
            taken.add(d)
    return to


def covered(windows: list) -> tuple[int, int, int]:
    """Item tokens, those of them in the item's own windows, and distinct windows that consistent
    windows of one region cover.

    The map of slots is taken from all windows of the region, or from those of one alignment where
    that covers more (as between two copies with other values side by side).
    """
    def cover(kept: list) -> tuple[int, int, int]:
        tokens, own = set(), set()
        for w in kept:
            span = range(w["b_pos"], w["b_pos"] + w["span"])
            tokens.update(span)
            if w["own"]:
                own.update(span)
        return len(tokens), len(own), len({(w["b_pos"], w["span"]) for w in kept})

    def by(seed: list) -> tuple[int, int, int]:
        to = _majority(seed)
        ends = set(to.values())
        fits = lambda b, d: to[b] == d if b in to else d not in ends
        kept = [w for w in windows if all(map(fits, w["b_slots"], w["slots"]))]
        rest = _majority(kept)                      # values that the seed does not hold
        return cover([w for w in kept if all(rest.get(b) == d for b, d in zip(w["b_slots"], w["slots"]))])

    all_, best = cover(windows), by(windows)
    if best < all_:
        alignments = defaultdict(list)
        for w in windows:
            alignments[w["shift"]].append(w)
        for shift in sorted(alignments, key=lambda x: -len(alignments[x])):
            best = max(best, by(alignments[shift]))
            if best == all_:
                break
    return best


def reworded(windows: list) -> bool:
    """Whether some slot is seen with other values only than the item's."""
    own, other = set(), set()
    for w in windows:
        for at, b, d in zip(w["b_at"], w["b_slots"], w["slots"]):
            (own if b == d else other).add(at)
    return bool(other - own)


def find_items(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, doc_row, item_id, windows, coverage, reworded``: one row for each item found in a
    document. ``docs`` has ``doc_id, doc_row, text``; rows with one ``doc_row`` are one text.
    ``coverage`` is the share of the item's tokens in ``windows`` distinct windows; ``reworded`` says
    that some slot holds another value than the item's."""
    b = cut(benchmark_windows(benchmark))
    kinds = sorted((r.literal, r.width) for r in b.select("literal", "width").distinct().collect())   # at most 2 * WINDOW
    d = document_windows(docs, bitmap(b), kinds)
    any_shared = not b.where("NOT own").isEmpty()
    if any_shared:
        d = cut(d)
    b = b.drop("literal", "width")
    fits = F.size("slots") == F.size("b_slots")
    m = d.join(b.where("own"), "h").where(fits)
    if any_shared:
        # Shared windows confirm: only for the items that their own windows found in a document.
        asked = m.select("doc_id", "doc_row", "item_row").distinct().join(b.where("NOT own"), "item_row")
        m = cut(m).unionByName(_confirming(d, asked).where(fits))
    m = m.withColumn("shift", F.col("pos") - F.col("b_pos"))
    # Two grids, half a cell apart: shifts within half a cell of each other share a cell of one.
    half = F.greatest(F.lit(WINDOW), F.ceil(F.col("n_tokens") / 2).cast("int"))
    cell = lambda grid: F.struct(
        F.lit(grid).alias("grid"), F.floor((F.col("shift") + grid * half) / (2 * half)).alias("at"))
    m = m.withColumn("cell", F.explode(F.array(cell(0), cell(1))))
    # A cell holds few shifts, so its set is bounded by the item's length, however long the document.
    g = m.groupBy("doc_id", "doc_row", "item_id", "item_row", "n_tokens", "own_tokens", "cell").agg(
        F.sum("span").alias("most"),
        F.collect_set(F.struct("shift", "b_pos", "span", "b_at", "b_slots", "slots", "own")).alias("found"))
    g = g.where(F.col("most") >= F.col("n_tokens") * coverage)

    @F.pandas_udf("tokens int, own int, windows int, reworded boolean")
    def judge(found: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(*covered(w), reworded(w)) for w in (list(x) for x in found)],
                            columns=["tokens", "own", "windows", "reworded"])

    g = g.withColumn("j", judge("found")).withColumn("coverage", F.col("j.tokens") / F.col("n_tokens"))
    g = g.where((F.col("coverage") >= coverage) & (F.col("j.own") >= F.col("own_tokens") * coverage))
    best = F.max(F.struct("coverage", F.col("j.windows").alias("windows"), F.col("j.reworded").alias("reworded")))
    return g.groupBy("doc_id", "doc_row", "item_id").agg(best.alias("m")).select(
        "doc_id", "doc_row", "item_id", "m.windows", "m.coverage", "m.reworded")


def _confirming(windows: DataFrame, asked: DataFrame) -> DataFrame:
    """The windows of documents that are shared windows of an item found there by its own."""
    a = asked.withColumnsRenamed({"doc_id": "a_id", "doc_row": "a_row", "h": "a_h"})
    same = (F.col("doc_row") == F.col("a_row")) & F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("h") == F.col("a_h"))
    return windows.join(a, same).drop("a_id", "a_row", "a_h")


def with_row_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.withColumn("doc_row", F.xxhash64("doc_id", "text"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found."""
    found = cut(find_items(with_row_key(docs, doc_id, text), benchmark).select("doc_row").distinct())
    if found.count() <= MAX_BROADCAST_ROWS:
        found = F.broadcast(found)
    d = packed(docs)
    row = F.xxhash64(F.col(f"__row.`{doc_id}`").cast("long"), F.col(f"__row.`{text}`"))
    return d.withColumn("doc_row", row).join(found, "doc_row", "left_anti").select("__row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = with_row_key(table(spark, sf_dir, "documents", "doc_id", "text"))
    return find_items(docs, table(spark, sf_dir, "benchmark", "item_id", "text")).select(
        "doc_id", "item_id", F.col("windows").cast("long"), F.round("coverage", 6).alias("coverage"),
        "reworded")
