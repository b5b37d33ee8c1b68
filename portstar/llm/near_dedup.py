r"""Near-duplicate detection with MinHash bands and odd sketches.

Words are ``[^\x20\x09-\x0D]+`` of the text with A-Z lower-cased; a document's set holds its
distinct shingles of ``words`` words, ``SHINGLE`` unless the caller says otherwise (fewer words: the
whole sequence). Two documents are linked
where ``100 * |A and B| >= 80 * |A or B|``.

1. One pass over the texts gives each document's set key (equal sets share one *class*, which is
   compared once however many copies it has), its MinHash band keys, and its odd sketch: one
   MinHash sample for each of ``BINS`` bins, folded into a parity bitmap of ``BITS`` bits.
2. Classes that share a band key are candidates. Every bucket's members are first compared with
   the one of the smallest id (a star: copies are nearer to what they were made from than to each
   other, and the first document is the likeliest origin). The population count of two sketches'
   exclusive or estimates their similarity; only pairs that may reach 0.8 (within ``SIGMAS``
   standard errors) go on to the exact check on full sets. Confirmed links join most of each group.
3. Buckets whose members are not yet in one component are searched for the remaining links: each
   member outside the bucket's largest component is compared with all members of other components.
   A task holds at most ``CHUNK`` members on either side, pairs are met in the first band they share
   only, and just the pairs that the sketches let pass leave it, again for the exact check.
4. Components follow from all confirmed links.

So no pair inside a component is listed, every pair in a common bucket that could join two
components is examined, and no bucket, copy group or chain is capped. 24 bands of 4 rows miss a
pair at similarity 0.8 with probability 4e-6, and at 0.9 below 1e-11.

Defined results. No words, or null text: an empty set, linked with nothing, its own component.
Null id: kept as a row; a component's id is the smallest id that is not null (null if there is
none; ids stay below 2^63 - 1). Repeated rows are linked like any equal texts. Empty table: no rows. Extra columns travel
along in :func:`keep_one` whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import cut, packed, table
from portstar.llm.components import components

SHINGLE = 4
MAX_SHINGLE = 16
PERCENT = 80
BANDS, ROWS = 24, 4
BINS, BITS = 1024, 2048
CHUNK = 1024
SIGMAS = 4.5
MAX_BROADCAST_IDS = 1_000_000      # 8-byte class numbers
NO_ID = (1 << 63) - 1              # stands for a null id, behind all others
PAIR = ["a", "b", "a_o", "b_o"]    # two classes, and the smallest id of each

_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_P = _rng.integers(1, 1 << 63, MAX_SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _WordNumbers(dict):
    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, numbers: _WordNumbers, words: int = SHINGLE) -> np.ndarray:
    """The document's distinct shingles of ``words`` words as sorted 64-bit hashes."""
    if not 1 <= words <= MAX_SHINGLE:
        raise ValueError(f"shingles have 1 to {MAX_SHINGLE} words, not {words}")
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()   # ASCII rules only
    n = len(found)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    x = np.fromiter((numbers[w] for w in found), dtype=np.uint64, count=n)
    k = min(n, words)
    h = np.full(n - k + 1, k, dtype=np.uint64)
    for j in range(k):
        h += x[j:n - k + 1 + j] * _P[j]
    return np.unique(_mix(h))


def band_keys(s: np.ndarray) -> np.ndarray:
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(s), 4096):                 # bounded memory for very long texts
        np.minimum(low, (s[i:i + 4096, None] * _A + _B).min(axis=0), out=low)
    m = low.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + m[:, j])
    return key.view(np.int64)


def odd_sketch(s: np.ndarray) -> bytes:
    """Parity bitmap of the MinHash samples (one for each filled bin), then the bins' bitmap."""
    bins = s >> np.uint64(64 - int(math.log2(BINS)))
    first = np.ones(len(s), dtype=bool)
    first[1:] = bins[1:] != bins[:-1]                # s is sorted: a bin's first is its minimum
    at = (_mix(s[first] ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & np.uint64(BITS - 1)).astype(np.int64)
    bits = (np.bincount(at, minlength=BITS) & 1).astype(np.uint8)
    full = np.bincount(bins[first].astype(np.int64), minlength=BINS).astype(np.uint8)
    return np.packbits(bits).tobytes() + np.packbits(full).tobytes()


def signatures(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id, row, node, n, bands, sketch`` from ``doc_id, row, text``; ``node`` numbers the class."""
    schema = "doc_id long, row long, node long, n long, bands array<long>, sketch binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = _WordNumbers()
        for b in batches:
            out = []
            for t in b["text"]:
                s = shingle_set(t, numbers, words)
                if len(s):
                    node = xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63)
                    out.append((node, len(s), band_keys(s), odd_sketch(s)))
                else:
                    out.append((None, 0, None, None))
            done = pd.DataFrame(out, columns=["node", "n", "bands", "sketch"], index=b.index)
            done["node"] = pd.array([x[0] for x in out], dtype="Int64")
            done.insert(0, "row", b["row"])
            done.insert(0, "doc_id", b["doc_id"].astype("Int64"))
            yield done

    return docs.select("doc_id", "row", "text").mapInPandas(run, schema)


def shingle_sets(docs: DataFrame, nodes: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``node, shingles`` of the classes in ``nodes`` (``row, node``: a row that holds the class's text),
    from the texts."""
    schema = "node long, shingles array<long>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = _WordNumbers()
        for b in batches:
            out = []
            for node, t in zip(b["node"], b["text"]):
                s = shingle_set(t, numbers, words)
                if len(s) and xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) == node:
                    out.append((node, s.view(np.int64)))
            yield pd.DataFrame(out, columns=["node", "shingles"])

    wanted = nodes.select("row", "node")
    if wanted.count() <= MAX_BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    d = docs.select("row", "text").join(wanted, "row").select("node", "text")
    return d.mapInPandas(run, schema).dropDuplicates(["node"])


# --- the odd sketch estimate -------------------------------------------------------------------

def _words(sketches) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), dtype=np.uint64).reshape(-1, (BITS + BINS) // 64)


def may_be_near(a: np.ndarray, b: np.ndarray, n1, n2) -> np.ndarray:
    """Whether sketches (rows of 64-bit words) can belong to sets of similarity 0.8 or more.

    ``n1`` and ``n2`` are the set sizes. The odd bits of the exclusive or give the samples'
    symmetric difference; the bins that either set fills are counted. The margin is ``SIGMAS``
    standard errors of folding and of sampling at the threshold.
    """
    j, split = PERCENT / 100, BITS // 64
    odd = np.bitwise_count(a[..., :split] ^ b[..., :split]).sum(axis=-1)
    filled = {k: np.bitwise_count(v[..., split:]).sum(axis=-1).astype(np.float64)
              for k, v in (("a", a), ("b", b), ("either", a | b))}
    diff = -BITS / 2 * np.log1p(-np.minimum(2.0 * odd / BITS, 0.999))
    bins = np.maximum(filled["either"], 1.0)
    share = (filled["a"] + filled["b"] - diff) / 2 / bins
    at = np.maximum(filled["a"] + filled["b"] - 2 * j * bins, 0)   # the difference at the threshold
    fold = np.maximum(BITS / 4 * np.expm1(4 * at / BITS) - at, 0) + 1
    union = np.maximum((n1 + n2) / (1 + j), bins)
    spread = np.sqrt(fold / (2 * bins) ** 2 + j * (1 - j) / bins * (1 - bins / union))
    fits = np.minimum(n1, n2) * 100 >= PERCENT * np.maximum(n1, n2)
    return fits & (share >= j - SIGMAS * spread - 0.004)


def _sketch_filter(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose sketches do not rule out a link."""
    n = nodes.select("node", F.struct("n", "sketch").alias("s"))
    p = (pairs.join(n.withColumnsRenamed({"node": "a", "s": "sa"}), "a")
              .join(n.withColumnsRenamed({"node": "b", "s": "sb"}), "b"))

    @F.pandas_udf("boolean")
    def near(sa: pd.DataFrame, sb: pd.DataFrame) -> pd.Series:
        if not len(sa):
            return pd.Series([], dtype=bool)
        return pd.Series(may_be_near(_words(sa["sketch"]), _words(sb["sketch"]),
                                     sa["n"].to_numpy(np.float64), sb["n"].to_numpy(np.float64)))

    return p.where(near("sa", "sb")).select(*PAIR)


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are near on their full sets."""
    p = (pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "x"}), "a")
              .join(sets.withColumnsRenamed({"node": "b", "shingles": "y"}), "b"))
    both = F.size(F.array_intersect("x", "y"))
    return p.withColumn("both", both).where(
        F.col("both") * 100 >= (F.size("x") + F.size("y") - F.col("both")) * PERCENT).select(*PAIR)


def _representatives(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return classes.select("node", "row").join(used, "node", "left_semi")


def _ends(a: Column, b: Column) -> list[Column]:
    """A pair's classes (structs ``node, o``), the smaller node first, in the columns ``PAIR``."""
    low, high = F.least(a, b), F.greatest(a, b)
    return [low["node"].alias("a"), high["node"].alias("b"), low["o"].alias("a_o"), high["o"].alias("b_o")]


def _labelled_components(links: DataFrame, key: str) -> DataFrame:
    """``<key>, root, root_o`` of linked classes: ``root`` is the key of the component's class with the
    smallest id ``root_o``. Nodes are labelled so that the smallest label is that class, and no class has
    to look its component up: by their smallest id where that is ``key`` (unique), else by id and node."""
    if key == "o":
        found = components(links.select(F.col("a_o").alias("a"), F.col("b_o").alias("b")))
        return found.select(F.col("node").alias("o"), "root", F.col("root").alias("root_o"))
    found = components(links.select(F.struct(F.col("a_o").alias("o"), F.col("a").alias("node")).alias("a"),
                                    F.struct(F.col("b_o").alias("o"), F.col("b").alias("node")).alias("b")))
    return found.select("node.node", F.col("root.node").alias("root"), F.col("root.o").alias("root_o"))


def _cross_pairs(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs across components of one bucket that the sketches let pass.

    ``members``: ``band, key, node, o, root, n, sketch, bands``; ``sizes``: ``band, key, root, c``.
    """
    total = sizes.groupBy("band", "key").agg(
        F.sum("c").alias("size"), F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("parts"))
    open_ = total.where("parts > 1").select(
        "band", "key", F.col("top.root").alias("top_root"),
        F.ceil((F.col("size") - F.col("top.c")) / CHUNK).cast("int").alias("left"),
        F.ceil(F.col("size") / CHUNK).cast("int").alias("right"))
    m = members.join(open_, ["band", "key"])
    slot = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "node"), n.cast("long")).cast("int")
    all_left = F.sequence(F.lit(0), F.col("left") - 1)
    all_right = F.sequence(F.lit(0), F.col("right") - 1)
    body = ["band", "key", "node", "o", "root", "n", "sketch", "bands"]
    asks = m.where(F.col("root") != F.col("top_root")).select(
        *body, slot(F.col("left"), 1).alias("i"), F.explode(all_right).alias("j"), F.lit(True).alias("asks"))
    answers = m.select(*body, F.explode(all_left).alias("i"), slot(F.col("right"), 2).alias("j"),
                       F.lit(False).alias("asks"))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        q, t = g[g["asks"]], g[~g["asks"]]
        if not len(q) or not len(t):
            return pd.DataFrame({c: [] for c in PAIR}, dtype="int64")
        ws, wt = _words(q["sketch"]), _words(t["sketch"])
        bs, bt = np.stack(q["bands"].to_numpy()), np.stack(t["bands"].to_numpy())
        ns, nt = q["n"].to_numpy(np.float64), t["n"].to_numpy(np.float64)
        node_s, node_t = q["node"].to_numpy(), t["node"].to_numpy()
        o_s, o_t = q["o"].to_numpy(), t["o"].to_numpy()
        root_s, root_t = q["root"].to_numpy(), t["root"].to_numpy()
        band, out = int(g["band"].iloc[0]), []
        asked = set(node_s.tolist())
        is_asker = np.fromiter((x in asked for x in node_t.tolist()), dtype=bool, count=len(node_t))
        for k in range(len(q)):
            # a pair of two askers is met twice, from either side: keep one of them
            ok = (root_t != root_s[k]) & ~(is_asker & (node_t < node_s[k]))
            if band:
                ok &= ~(bt[:, :band] == bs[k, :band]).any(axis=1)
            at = np.flatnonzero(ok)
            if len(at):
                at = at[may_be_near(ws[k][None, :], wt[at], ns[k], nt[at])]
                own = np.full(len(at), node_s[k]), np.full(len(at), o_s[k])
                first = node_s[k] < node_t[at]
                out.append(np.stack([np.where(first, own[0], node_t[at]), np.where(first, node_t[at], own[0]),
                                     np.where(first, own[1], o_t[at]), np.where(first, o_t[at], own[1])], axis=1))
        p = np.concatenate(out) if out else np.zeros((0, 4), dtype=np.int64)
        return pd.DataFrame(p, columns=PAIR)

    found = asks.unionAll(answers).groupBy("band", "key", "i", "j").applyInPandas(
        run, ", ".join(f"{c} long" for c in PAIR))
    return found.distinct()


def near_links(docs: DataFrame, signed: DataFrame, words: int = SHINGLE) -> tuple[DataFrame, DataFrame, str]:
    """Classes (``node, o, row, ...``), :func:`_labelled_components` of all that are linked, and their key."""
    order = F.coalesce("doc_id", F.lit(NO_ID).cast("long"))
    classes = signed.where("node is not null").groupBy("node").agg(
        F.min(F.struct(order.alias("o"), "row")).alias("least"), F.first("n").alias("n"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = cut(classes.select("node", "least.o", "least.row", "n", "bands", "sketch"))
    ids = classes.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o").alias("ids"), F.max("o").alias("last")).first()
    key = "o" if ids.n == ids.ids and (ids.last is None or ids.last < NO_ID) else "node"
    members = classes.select("node", "o", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("band", "key").agg(
        F.min(F.struct("o", "node")).alias("first"), F.count(F.lit(1)).alias("c"))
    buckets = buckets.where("c > 1").select("band", "key", "first")
    members = cut(members.join(buckets, ["band", "key"]))

    star = members.where(F.col("node") != F.col("first.node")).select(*_ends(
        F.struct("node", "o"), F.struct("first.node", "first.o"))).distinct()
    star = cut(_sketch_filter(star, classes))
    links = cut(_confirm(star, shingle_sets(docs, _representatives(star, classes), words)))
    roots = _labelled_components(links, key)

    rooted = members.join(roots, key, "left").select(
        "band", "key", "node", "o", F.coalesce("root", key).alias("root"))
    sizes = rooted.groupBy("band", "key", "root").agg(F.count(F.lit(1)).alias("c"))
    full = rooted.join(classes.select("node", "n", "sketch", "bands"), "node")
    rest = cut(_cross_pairs(full, sizes).join(star, ["a", "b"], "left_anti"))
    more = cut(_confirm(rest, shingle_sets(docs, _representatives(rest, classes), words)))
    return classes, _labelled_components(links.unionAll(more), key), key


def assign(docs: DataFrame, signed: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id, row, node, n, root, is_root, component_id`` for every row of ``signed``; ``root`` stands
    for the component, ``is_root`` marks rows of the class that holds its smallest id."""
    classes, roots, key = near_links(docs, signed, words)
    # stored, so that the join below has a shuffle of its own on either side: only then does adaptive
    # execution split a class of very many copies
    by_node = cut(classes.select("node", "o").join(roots, key, "left").select(
        "node", F.coalesce("root", key).alias("root"), F.coalesce("root_o", "o").alias("least"),
        (F.coalesce("root", key) == F.col(key)).alias("is_root")))
    component = F.when(F.col("least") != NO_ID, F.col("least"))
    return signed.select("doc_id", "row", "node", "n").join(by_node, "node", "left").select(
        "doc_id", "row", "node", "n", "root", "is_root",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(component).alias("component_id"))


def _text_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.withColumn("row", F.xxhash64("doc_id", "text"))


def near_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    words: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    d = _text_rows(docs, doc_id, text)
    signed = cut(signatures(d, words))
    return assign(d, signed, words).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             words: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` but near-duplicates: of each group the row with the smallest id stays
    (of several texts with that id, one). All rows without words stay. Of rows with words that repeat
    both id and text, one stays."""
    d = _text_rows(docs, doc_id, text)
    found = cut(assign(d, cut(signatures(d, words)), words))
    with_words = found.where("node is not null")
    kept = with_words.where(F.col("is_root") & F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.groupBy("root").agg(F.min("row").alias("row"))
    gone = cut(with_words.select("row").distinct().join(kept, "row", "left_anti"))
    if gone.count() <= MAX_BROADCAST_IDS:
        gone = F.broadcast(gone)
    rows = packed(docs).withColumn("row", F.xxhash64(F.col(f"__row.`{doc_id}`").cast("long"),
                                                     F.col(f"__row.`{text}`")))
    left = rows.join(gone, "row", "left_anti")
    again = found.where("node is not null").join(gone, "row", "left_anti").groupBy("row").agg(F.count(F.lit(1)).alias("c"))
    if not again.where("c > 1").isEmpty():
        has_words = F.coalesce(F.col(f"__row.`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        left = left.where(has_words).dropDuplicates(["row"]).unionAll(left.where(~has_words))
    return left.select("__row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents", "doc_id", "text"))
