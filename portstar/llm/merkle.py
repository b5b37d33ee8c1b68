r"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces of paragraphs.

Leaves are consecutive pieces of the text that add up to it: nothing between them is left out. A
piece ends with its line, after the blanks behind a sentence end, after an ideographic full stop, after
``LEAST`` characters with a word on one of a few fixed letters (a cut by content, so that an insertion
into a text without sentences moves a few borders only), and at ``MOST`` characters at the latest. A
paragraph is a line; its node hashes its leaves, a section's node its paragraphs, the root its sections.
A section ends at a blank line and after every line whose last leaf has one of two of 16 first digits,
so that an insertion moves no section border but its own.

A fingerprint is one string: the root (32 hex digits), ``:``, then the leaves (32 hex digits each)
with ``,`` between leaves, ``;`` between paragraphs and ``/`` between sections. Leaves and root are
the first half of a SHA-256. Inner nodes follow from the leaves. Roots are equal where texts are equal,
and only there; :func:`likeness` compares the leaves, and :func:`changed_sections` descends only where
section hashes differ.

Defined results. Null text: the empty text, which has one leaf. Very long texts have as many leaves as
they need. The next document of a row is the next in ascending ``doc_id`` (null first), rows with one id
ordered by the text's hash, then text; the last row's next is the first. A single row is its own next.
Rows that repeat id and text follow each other (and share a task). Empty table: no rows. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portstar.llm.common import cut, let, table

LEAST, MOST = 24, 80
_END = r"\n|[.!?][ \t]{1,8}(?![ \t])|[\u3002\uFF01\uFF1F]"
_PIECE = (rf"(?s)(?:.{{0,{LEAST - 1}}}?(?:{_END})|.{{{LEAST},{MOST}}}?(?:{_END}|(?<=[dny])[ \t])"
          rf"|.{{1,{MOST}}})")


def pieces(text: Column) -> Column:
    """The text cut into leaves; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(_PIECE), 0)


def _digest(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 32)


def _leaves(text: Column) -> Column:
    """The text's leaf hashes as one string with ``,``, ``;`` and ``/`` between them."""

    def leaf(piece: Column) -> Column:
        return let(_digest(piece), lambda h: F.concat(h, F.when(~F.endswith(piece, F.lit("\n")), ",").when(
            piece.rlike(r"^[ \t\r]*\n$") | F.substring(h, 1, 1).isin("0", "8"), "/").otherwise(";")))

    joined = F.array_join(F.transform(F.when(text == "", F.array(F.lit(""))).otherwise(pieces(text)), leaf), "")
    return let(joined, lambda j: F.substring(j, F.lit(1), F.length(j) - 1))


def _nodes(leaves: Column) -> Column:
    """Section hashes (hex) from the leaf string: each hashes its paragraphs' hashes."""
    return F.transform(F.split(leaves, "/"), lambda s: F.sha2(F.array_join(
        F.transform(F.split(s, ";"), lambda p: F.sha2(p, 256)), ""), 256))


def fingerprint_of_leaves(leaves: Column) -> Column:
    return let(leaves, lambda x: F.concat(_digest(F.array_join(_nodes(x), "")), F.lit(":"), x))


def root(fingerprint: Column) -> Column:
    return F.substring(fingerprint, 1, 32)


def _numbered(leaves: Column) -> Column:
    """The leaves with the second, third, ... occurrence of one made different, so that sets of them
    are multisets of leaves. Sorted, so every step is linear in the number of leaves."""
    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(s)),
                          lambda i: (i == 1) | (F.element_at(s, i) != F.get(s, i - 2)))
        return let(starts, lambda at: F.flatten(F.transform(at, lambda first, k: let(
            F.coalesce(F.get(at, k + 1), F.size(s) + 1) - first, lambda n: F.transform(
                F.sequence(F.lit(0), n - 1), lambda j: F.when(j == 0, F.element_at(s, first)).otherwise(
                    F.concat(F.element_at(s, first), j.cast("string"))))))))

    return F.when(F.size(F.array_distinct(leaves)) == F.size(leaves), leaves).otherwise(
        let(F.sort_array(leaves), runs))


def _leaf_array(fingerprint: Column) -> Column:
    return F.split(F.substring(fingerprint, F.lit(34), F.length(fingerprint)), "[/;,]")


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of the two trees' leaves, each counted as often as it occurs; 1 for equal roots."""
    dice = let(F.struct(_leaf_array(a).alias("x"), _leaf_array(b).alias("y")), lambda v: F.size(
        F.array_intersect(_numbered(v.x), _numbered(v.y))) * 2.0 / (F.size(v.x) + F.size(v.y)))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(dice)


def changed_sections(a: Column, b: Column) -> Column:
    """Zero-based positions of the sections of ``a`` whose node does not occur in ``b``."""
    x = _nodes(F.substring(a, F.lit(34), F.length(a)))
    y = _nodes(F.substring(b, F.lit(34), F.length(b)))
    marked = F.transform(x, lambda s, i: F.when(~F.array_contains(y, s), i))
    return F.filter(marked, lambda i: i.isNotNull())


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of ``text``; all other columns stay."""
    leaves = _leaves(F.coalesce(F.col(text), F.lit("")))
    return docs.withColumn(out, fingerprint_of_leaves(leaves))


# --- the next document in id order, without a global window ------------------------------------

_LOW = -(1 << 63)
MAX_RANGES = 1 << 20           # 16 bytes each in the one row that is broadcast
ROWS_PER_RANGE = 4096
_STRIDE = 256                  # least step of the coarse list


def range_starts(keys: DataFrame, rows_per_range: int) -> DataFrame:
    """One row with the first keys (``ord, h``) of consecutive ranges, about ``rows_per_range`` rows
    each: ``coarse`` has every ``stride``-th of ``fine``.

    Range partitioning only chooses where to cut: whatever it samples, the smallest key of each
    partition is a proper border between rows. The list stays in Spark, as a checkpointed row.
    """
    parts = max(1, min(MAX_RANGES, -(-keys.count() // rows_per_range)))
    stride = max(_STRIDE, int(parts ** 0.5))
    firsts = (keys.repartitionByRange(parts, "ord", "h").groupBy(F.spark_partition_id().alias("p"))
                  .agg(F.min(F.struct("ord", "h")).alias("o")))
    fine = firsts.agg(F.sort_array(F.collect_set("o")).alias("fine"))
    return cut(fine.select("fine", F.lit(stride).alias("stride"), F.filter(
        "fine", lambda _, i: i % stride == 0).alias("coarse")))


def _range_of(key: Column) -> Column:
    """Zero-based index of the last start that is not above ``key``, in two steps of about the square
    root of the number of ranges."""
    below = lambda starts: F.size(F.filter(starts, lambda s: s <= key))
    at = (below(F.col("coarse")) - 1) * F.col("stride")
    return let(at, lambda a: a + below(F.slice(F.col("fine"), a + 1, F.col("stride"))) - 1)


def with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``doc_id, text, range, late, ord, h`` in key ranges, every range followed by the first rows of
    the next one (``late`` above 0), so that ``lead`` over :func:`range_window` finds each row's
    successor."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"),
                    F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW).cast("long")).alias("ord"))
    d = d.crossJoin(F.broadcast(range_starts(d.select("ord", "h"), rows_per_range)))       # one row
    d = d.withColumn("range", _range_of(F.struct("ord", "h")))
    last = F.size("fine") - 1
    is_first = F.struct("ord", "h") == F.element_at("fine", F.col("range") + 1)
    here = F.struct(F.col("range").alias("range"), F.lit(0).alias("late"))
    before = F.when(F.col("range") > 0, F.struct((F.col("range") - 1).alias("range"), F.lit(1).alias("late"))).otherwise(
        F.struct(last.alias("range"), F.lit(2).alias("late")))
    d = d.withColumn("c", F.explode(F.when(is_first, F.array(here, before)).otherwise(F.array(here))))
    return d.select("doc_id", "text", F.col("c.range").alias("range"), F.col("c.late").alias("late"), "ord", "h")


def range_window():
    return Window.partitionBy("range").orderBy("late", "ord", "h", "text")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    w = range_window()
    d = with_next(docs)
    d = d.withColumn("next_text", F.lead("text").over(w))
    n = F.char_length("text")
    half = F.expr("char_length(text) div 2").cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    d = d.select("doc_id", "range", "late", "ord", "h", "text", n.cast("long").alias("n_chars"),
                 F.when(F.col("late") == 0, edited).alias("edited"))
    d = fingerprints(d)
    d = d.withColumn("next_fingerprint", F.lead("fingerprint").over(w)).where("late = 0")
    d = d.drop("text").withColumn("edited_fingerprint", fingerprint_of_leaves(_leaves(F.col("edited"))))
    return d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
