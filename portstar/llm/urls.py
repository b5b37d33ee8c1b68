"""URL filter: a blocked Bloom filter in front of an exact hash join.

Rules name a host and a path start. A rule fits a URL when the URL's host is the rule's host or one
of its subdomains and the URL's path starts with the rule's path; of several fitting rules the one
with the longest ``host + path`` wins (then the longer host).

For each distinct (host, path) the possible keys are the host's suffixes combined with the path's
starts, in just those (labels, length) shapes that some rule has. A blocked Bloom filter of the
rules' keys (one 256-bit block per key, four 64-bit words, two bits set in each) drops nearly all
of them; the filter has at most ``MAX_BLOCKS`` blocks (a fixed bound on what is broadcast), however
many rules there are. What passes goes to an exact hash join with the rules, which removes false
positives. More rules than the bound suits only make the filter pass more.

Defined results. Null URL or no ``://``: empty host and path, no rule, verdict of the method
(``allow``). Repeated rows are kept. Rules that repeat one key: the smallest verdict by name wins.
Null rule host or path counts as empty. Empty tables: no rows, or no rule fits. Extra columns
travel along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import packed, table

BITS_PER_KEY = 16
BLOCK_BITS = 256
MAX_BLOCKS = 1 << 18          # 8 MiB of filter words
# Odd multipliers, one for each of the eight bits of a key.
SALTS = [2 * (0x3C6EF372 + 0x1F83D9AB * i) % (1 << 31) + 1 for i in range(8)]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def _key_bits(h: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block number and the four word masks of a key hash."""
    low = h.bitwiseAND(F.lit(0x7FFFFFFF))
    bit = [F.shiftright((low * F.lit(s)).bitwiseAND(F.lit(0x7FFFFFFF)), 25).cast("int") for s in SALTS]
    one = F.lit(1).cast("long")
    masks = [F.call_function("shiftleft", one, bit[2 * i]).bitwiseOR(
        F.call_function("shiftleft", one, bit[2 * i + 1])) for i in range(4)]
    return F.pmod(F.shiftrightunsigned(h, 32), F.lit(blocks).cast("long")), masks


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter's non-empty blocks, ``block, w0..w3``, from ``h``: at most ``blocks`` rows."""
    block, masks = _key_bits(F.col("h"), blocks)
    k = keys.select(block.alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return k.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def pass_bloom(candidates: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``candidates`` (with ``h``) whose key may be in the filter; never drops a member."""
    block, masks = _key_bits(F.col("h"), blocks)
    c = candidates.withColumn("block", block).join(F.broadcast(bloom), "block")
    for i, m in enumerate(masks):
        c = c.where(F.col(f"w{i}").bitwiseAND(m) == m)
    return c.drop("block", *[f"w{i}" for i in range(4)])


def _clean_rules(rules: DataFrame) -> DataFrame:
    host = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER)
    r = rules.select(host.alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
    return r.groupBy("r_host", "r_path").agg(F.min("verdict").alias("verdict"))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` for the distinct (host, path) that some rule fits."""
    r = _clean_rules(rules)
    shape = r.groupBy(F.size(F.split("r_host", r"\.")).alias("labels"),
                      F.char_length("r_path").alias("n")).agg(F.count(F.lit(1)).alias("rules"))
    # one row per shape of rule: at most (labels in a host) x (length of a path)
    shapes = [(s.labels, s.n, s.rules) for s in shape.collect()]
    blocks = max(1, min(MAX_BLOCKS, sum(s[2] for s in shapes) * BITS_PER_KEY // BLOCK_BITS + 1))
    bloom = bloom_blocks(r.select(F.xxhash64("r_host", "r_path").alias("h")), blocks)

    by_labels: dict[int, list[int]] = {}
    for labels, n, _ in shapes:
        by_labels.setdefault(labels, []).append(n)
    labels = F.size(F.split("host", r"\."))

    def keys_of(k: int, lengths: list[int]) -> Column:
        """The URL's host suffix of ``k`` labels with the path's starts of the given lengths."""
        fitting = F.filter(F.lit(sorted(lengths)), lambda n: n <= F.char_length("path"))
        made = F.transform(fitting, lambda n: F.struct(
            F.substring_index("host", ".", -k).alias("r_host"),
            F.substring(F.col("path"), F.lit(1), n).alias("r_path")))
        return F.when(labels >= k, made).otherwise(F.array().cast(made_type))

    made_type = "array<struct<r_host:string,r_path:string>>"
    keys = F.lit(None).cast(made_type)
    parts = [keys_of(k, lengths) for k, lengths in sorted(by_labels.items())]
    keys = F.concat(*parts) if parts else keys
    c = urls.select("host", "path").distinct().select("host", "path", F.explode(keys).alias("k"))
    c = c.select("host", "path", "k.r_host", "k.r_path")
    c = c.withColumn("h", F.xxhash64("r_host", "r_path"))
    hits = pass_bloom(c, bloom, blocks).drop("h").join(r, ["r_host", "r_path"])
    rule = F.concat("r_host", "r_path")
    best = F.max(F.struct(F.char_length(rule).alias("a"), F.char_length("r_host").alias("b"),
                          rule.alias("rule"), "verdict"))
    return hits.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """``__row, host, path, rule, verdict`` for every row of ``pages``."""
    p = packed(pages)
    host, path = host_path(F.col(f"__row.`{url}`"))
    p = p.select("__row", host.alias("host"), path.alias("path"))
    found = match_rules(p, rules)
    return p.join(found, ["host", "path"], "left").select(
        "__row", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))


RULES_SQL = """
SELECT * FROM VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
  AS r(host, path, verdict)
"""


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return judge(pages, spark.sql(RULES_SQL)).select(
        "__row.page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
s AS (
  SELECT page_id, coalesce(CASE WHEN contains(url, '://')
    THEN substr(url, instr(url, '://') + 3) ELSE '' END, '') AS x FROM pages
), u AS (
  SELECT page_id,
    translate(regexp_extract(x, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM s
), m AS (
  SELECT u.*, (SELECT max(struct_pack(n := length(h || p), rule := h || p, verdict := v)) FROM r
    WHERE (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p)) AS best FROM u
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM m
"""
