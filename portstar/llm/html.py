"""Main text of web pages: the maximum-scoring run of tokens.

A page becomes a sequence of words and tags. Words score positive, words inside boilerplate
elements slightly negative; tags score negative, with weights learned from labelled pages. A linear
scan finds the contiguous run with the highest sum: the content region. Its text is every word of
the run that is not inside a boilerplate element.

Labelled pages are those with exactly one ``<article>``: tokens inside it are content. They give

* each tag's weight: a small cost for tags that are usual inside content, a cost that grows with
  the odds for tags that stand outside of it, so that the run does not cross a content border;
* further boilerplate elements: an element signature (name and classes) whose words never stand in
  content, on ``LEAST_PAGES`` pages or more, beside the fixed names and class words below;
* content elements: a signature that the fixed words call boilerplate but that holds ``CONTENT_SHARE``
  of an article's words or more, on average over ``LEAST_PAGES`` articles or more. Class words that name
  parts of texts as well (``WEAK_MARKS``) never count inside an article.

Weights are fitted on the ``FIT_PAGES`` pages that come first by a hash of their URL and id, of up
to ``FIT_CHARS`` code points each. Every page is extracted from its whole HTML.

Embedded elements (``EMBEDDED``), scripts and styles go with what they hold. An embedded element without
an end tag, or closed by its own slash, loses its tag only. A page is scanned in linear time, whatever
tags and quotes it leaves open.

Defined results. Null or empty HTML: the empty text. A page without a positive run: the empty text.
Without labelled pages: default weights. Of equal runs the first one counts. Repeated rows get equal
texts; extra columns travel along whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portstar.llm.common import packed, table

FIT_PAGES = 600
FIT_CHARS = 100_000
LEAST_PAGES = 20
CONTENT_SHARE = 0.2
WORD = 1.0
BOILERPLATE_WORD = -0.01
INSIDE_COST = 0.02
ODDS_COST = 10.0
UNSEEN_COST = 0.05

# Elements without content, elements of raw text, embedded elements, elements inside a line.
BOILERPLATE = frozenset("nav footer aside form menu dialog button select textarea noscript template "
                        "iframe object svg canvas audio video map fieldset".split())
RAW = frozenset("script style title textarea".split())
EMBEDDED = frozenset("noscript template svg iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                   "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class and id names that mark boilerplate.
MARKS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo "
                  "sidebar menu navbar nav navigation breadcrumb breadcrumbs footer header masthead "
                  "topbar toolbar notice notices cookie cookies consent gdpr popup modal overlay "
                  "comment comments discussion reply replies disqus respond share sharing social "
                  "related recommended newsletter subscribe subscription signup login search "
                  "pagination pager widget alert skip".split())
# Those of them that name parts of a text as well, so that they do not count inside an article.
WEAK_MARKS = frozenset("discussion header masthead related recommended search widget alert skip banner".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())

_NAMED = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
_ATTR = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Za-z]+")
_PLAIN = re.compile(r"[^>\"']*")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class _Scanner:
    """Splits HTML into texts, start tags and end tags in time linear in the page's length.

    Quotes in a tag hide a ``>``; where that leaves the tag without an end, the first ``>`` ends it.
    What no ``>`` follows is text. Searches that fail are remembered, and those of quoted tags are
    given up for the rest of the page once they have cost ``PATIENCE`` times its length.
    """

    PATIENCE = 4

    def __init__(self, page: str):
        self.page, self.n = page, len(page)
        self.last = page.rfind(">")
        self.spent = 0
        self.missing: set[str] = set()          # quotes and raw elements without an end from here on

    def _tag_end(self, at: int) -> int:
        """Index of the ``>`` that ends the tag whose name ends at ``at``, or -1."""
        page = self.page
        if at > self.last:
            return -1
        pos = at
        while self.spent <= self.PATIENCE * self.n:
            pos = _PLAIN.match(page, pos).end()
            if pos >= self.n:
                break
            c = page[pos]
            if c == ">":
                return pos
            end = -1 if c in self.missing else page.find(c, pos + 1)
            if end < 0:
                self.missing.add(c)
                break
            pos = end + 1
        self.spent += pos - at
        return page.find(">", at)

    def _raw_end(self, name: str, at: int) -> int:
        """Where the page goes on after a raw element. Unclosed scripts and styles reach to the end."""
        m = None if name in self.missing else _RAW_END[name].search(self.page, at)
        if m is None:
            self.missing.add(name)
            return self.n if name in ("script", "style") else at
        end = self.page.find(">", m.end())
        return self.n if end < 0 else end + 1

    def pieces(self) -> Iterator[tuple[str, str, str]]:
        """``("text", text, "")``, ``("open", name, attributes)`` or ``("close", name, "")``."""
        page, pos = self.page, 0
        while pos < self.n:
            lt = page.find("<", pos)
            if lt != pos:
                yield "text", page[pos:lt] if lt > 0 else page[pos:], ""
            if lt < 0:
                return
            if lt > self.last:                  # no tag ends from here on
                rest = page.find("<!--", lt)
                yield "text", page[lt:rest] if rest >= 0 else page[lt:], ""
                return
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2)
                pos = self.n if end < 0 else end + 3
                continue
            m = _NAMED.match(page, lt)
            end = -1
            if m is not None:
                end = self._tag_end(m.end())
            elif page[lt + 1:lt + 2] in ("!", "?"):
                pos = page.find(">", lt) + 1
                continue
            if end < 0:
                yield "text", "<", ""
                pos = lt + 1
                continue
            name, pos = m.group(1).lower(), end + 1
            if page[lt + 1] == "/":
                yield "close", name, ""
            elif name in RAW:
                pos = self._raw_end(name, pos)
            else:
                yield "open", name, page[m.end():end]


def _unwrapped(page: str) -> list[tuple[str, str, str]]:
    """The page's pieces without embedded elements. Their tags without a partner go alone; what
    follows them stays."""
    pieces = list(_Scanner(page).pieces())
    open_at: dict[str, list[int]] = {name: [] for name in EMBEDDED}
    end_of, alone = {}, set()
    for i, (kind, name, attr) in enumerate(pieces):
        if kind == "text" or name not in EMBEDDED:
            continue
        alone.add(i)
        if kind == "open" and not attr.rstrip().endswith("/"):
            open_at[name].append(i)
        elif kind == "close" and open_at[name]:
            end_of[open_at[name].pop()] = i
    out, i = [], 0
    while i < len(pieces):
        if i in end_of:
            i = end_of[i]
        elif i not in alone:
            out.append(pieces[i])
        i += 1
    return out


def _marks(name: str, attr: str) -> tuple[str, int]:
    """Signature of a start tag, and whether its class, id or role marks boilerplate: 2 anywhere, 1
    only outside an article, 0 not at all."""
    if not attr.strip():
        return name, 0
    words, marked = [], 0
    for key, *vals in _ATTR.findall(attr):
        key, value = key.lower(), next((v for v in vals if v), "")
        parts = [w.lower() for w in _NAME.findall(value)]
        if key == "role":
            marked = max(marked, 2 * any(p in ROLES for p in parts))
        elif key == "hidden":
            marked = 2
        else:
            marked = max([marked, *(1 if p in WEAK_MARKS else 2 for p in parts if p in MARKS)])
            if key == "class":
                words += parts
    return name + "".join("." + w for w in sorted(words)), marked


@dataclass
class Weights:
    cost: dict[str, float] = field(default_factory=dict)
    boilerplate: frozenset[str] = frozenset()
    content: frozenset[str] = frozenset()

    def of(self, tag: str) -> float:
        return self.cost.get(tag, 0.0 if tag.lstrip("/").split(".")[0] in INLINE else -UNSEEN_COST)


def tokens(page: str, boilerplate: frozenset[str] = frozenset(),
           content: frozenset[str] = frozenset()) -> Iterator[tuple[str, str, str | None]]:
    """``(kind, value, element)``: kind ``text`` or ``tag``; ``element`` is the signature of the
    outermost boilerplate element around the token, or None.

    An element ends with its end tag; unclosed ones end where the main content starts
    (the first ``<article>`` or ``<main>``) or with the element that holds them. Inside an article
    the signatures in ``content`` are none, whatever their names say.
    """
    stack: list[str] = []                 # open elements that are not inline or void
    opened = Counter()                    # how many of each are on the stack
    within, depth = None, 0               # boilerplate signature, size of the stack around it
    main, seen_main = 0, False
    for kind, name, attr in _unwrapped(page):
        if kind == "text":
            yield "text", name, within
            continue
        if kind == "close":
            if opened[name]:
                while True:
                    last = stack.pop()
                    opened[last] -= 1
                    if last == name:
                        break
            if name in ("article", "main"):
                main = max(0, main - 1)
            inside = within
            if within is not None and len(stack) <= depth:
                within = None
            yield "tag", "/" + name, inside
            continue
        signature, mark = _marks(name, attr)
        marked = mark > (1 if main else 0) and not (main and signature in content)
        if name in ("article", "main") and not marked:
            if within is not None and not seen_main:
                opened.subtract(stack[depth:])
                del stack[depth:]
                within = None
            main, seen_main = main + 1, True
        bad = (marked and name not in ("html", "body", "article", "main") or name in BOILERPLATE
               or name == "header" and not main or signature in boilerplate
               or marked and name == "article" and main > 0 or name == "head")
        if name not in VOID and not attr.rstrip().endswith("/"):
            if within is None and bad:
                within, depth = signature, len(stack)
            if name not in INLINE or bad:
                if name == "p" and stack and stack[-1] == "p":
                    stack.pop()
                    opened["p"] -= 1
                stack.append(name)
                opened[name] += 1
        yield "tag", signature, within


def _article_span(page: str) -> tuple[int, int] | None:
    starts = [m.end() for m in re.finditer(r"<article\b[^>]*>", page, re.I)]
    ends = [m.start() for m in re.finditer(r"</article\s*>", page, re.I)]
    return (starts[0], ends[0]) if len(starts) == len(ends) == 1 and starts[0] < ends[0] else None


def learn(pages: list[str]) -> Weights:
    """Tag weights, boilerplate and content signatures from the pages with exactly one ``<article>``."""
    inside, outside = Counter(), Counter()
    holds, lacks = Counter(), Counter()
    shares: dict[str, list[float]] = {}
    labelled = 0
    for page in pages:
        if _article_span(page) is None:
            continue
        labelled += 1
        content, stack, has = False, [], set()
        seen, words, total = set(), Counter(), 0
        for kind, value, element in tokens(page):
            if kind == "text":
                if content and value.strip():
                    has.update(stack)
                    n = len(value.split())
                    total += n
                    if element is not None:
                        words[element] += n
                continue
            name = value.split(".")[0]
            border = name in ("article", "/article")
            if name == "article":
                content = True
            if element is None:
                (inside if content and not border else outside)[value] += 1
            if name == "/article":
                content = False
            if name[0] == "/":
                while stack and stack.pop().split(".")[0] != name[1:]:
                    pass
            elif name not in VOID and name not in INLINE and name != "p":
                stack.append(value)
                seen.add(value)
        for s in seen:
            (holds if s in has or s.split(".")[0] == "article" else lacks)[s] += 1
        for s, n in words.items():
            shares.setdefault(s, []).append(n / total)
    if not labelled:
        return Weights()
    cost = {}
    for tag in {*inside, *outside}:
        odds = math.log((outside[tag] + 0.5) / (inside[tag] + 0.5))
        base = 0.0 if tag.lstrip("/").split(".")[0] in INLINE else INSIDE_COST
        cost[tag] = -base - ODDS_COST * max(0.0, odds)
    never = {s for s, n in lacks.items() if n >= LEAST_PAGES and not holds[s] and "." in s}
    # What takes up a good part of the articles is their text, whatever its class is called.
    much = {s for s, x in shares.items() if "." in s and s.split(".")[0] not in BOILERPLATE
            and len(x) >= LEAST_PAGES and sum(x) / len(x) >= CONTENT_SHARE}
    return Weights(cost, frozenset(never), frozenset(much))


_BREAK = "\n"


def scored(page: str, weights: Weights) -> tuple[list[float], list[str]]:
    """The score of each token and what it adds to the text: words, or a break."""
    scores, parts = [], []
    for kind, value, element in tokens(page, weights.boilerplate, weights.content):
        if kind == "tag":
            scores.append(weights.of(value) if element is None else 0.0)
            parts.append("" if value.lstrip("/").split(".")[0] in INLINE else _BREAK)
        else:
            text = html.unescape(value)
            scores.append((WORD if element is None else BOILERPLATE_WORD) * len(text.split()))
            parts.append(text if element is None else _BREAK)
    return scores, parts


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and one past the last place of the run with the highest positive sum: the first such
    run; (0, 0) without any."""
    best, span, run, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        run += score
        if run <= 0:
            run, start = 0.0, i + 1
        elif run > best:
            best, span = run, (start, i + 1)
    return span


def main_text(page: str | None, weights: Weights) -> str:
    """The words of the maximum-scoring run, without those in boilerplate elements."""
    if not page:
        return ""
    scores, parts = scored(page, weights)
    return " ".join("".join(parts[slice(*best_run(scores))]).split())


def train(pages: DataFrame, html_column: str = "html", *keys: str) -> Weights:
    """Weights from a bounded sample of the table: the hashes are ranked first, alone, so that no
    task sends more pages to the driver than are in the sample."""
    order = F.xxhash64(*[F.col(k) for k in keys or (html_column,)])
    usable = pages.where(F.char_length(html_column) <= FIT_CHARS).select(
        F.col(html_column).alias("h"), order.alias("o"))
    last = usable.select("o").distinct().orderBy("o").limit(FIT_PAGES).agg(F.max("o").alias("o")).first().o
    if last is None:
        return Weights()
    rows = usable.where(F.col("o") <= last).groupBy("o").agg(F.min("h").alias("h")).collect()
    return learn([r.h for r in sorted(rows, key=lambda r: r.o)])


def extract(pages: DataFrame, weights: Weights, html_column: str = "html") -> DataFrame:
    """``__row, text`` for every row of ``pages``."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([main_text(h, weights) for h in b], index=b.index, dtype=object)

    d = packed(pages)
    keep = [c for c in pages.columns if c != html_column]
    row = F.struct(*[F.col(f"__row.`{c}`").alias(c) for c in keep]) if keep else F.lit(None)
    return d.select(row.alias("__row"), run(F.col(f"__row.`{html_column}`")).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    weights = train(pages, "html", "url", "page_id")
    return extract(pages, weights).select(
        "__row.page_id", "__row.url", "text", F.char_length("text").cast("long").alias("n_chars"))
