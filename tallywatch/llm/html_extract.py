"""Main text of web pages as the maximum-scoring run of tokens.

A page is read as words and tags. Words score for content and tags against it; how much depends on the kind
of token (a plain word, a word inside a link or inside a menu; a paragraph tag, a list tag, a tag whose class
says "sidebar") and is learned from labelled pages, as the logarithm of how much likelier the kind is inside
the labelled content than outside. Pages whose author marked the content with an article or main element are
such labelled pages. One linear scan finds the contiguous run with the highest sum; what stands in menus,
adverts, forms or comments inside the run is left out.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.tables import map_batches

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"  # comment
    r"|<(script|style|noscript|template|svg|math|iframe|object|select|textarea|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"  # not read at all
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>"  # tag
    r"|<[!?][^>]*>",  # declaration
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
PART = re.compile(r"[a-z]+")

# Names from the HTML standard.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset(["article", "main"])
ASIDE = frozenset("nav aside footer form button dialog menu head".split())
KNOWN = INLINE | VOID | CONTENT | ASIDE | frozenset("html body header section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary fieldset".split())
# Words in class, id and role that mark what surrounds an article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side rail menu nav navbar navigation topnav breadcrumb breadcrumbs footer footnav "
    "masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login search social share sharing related recommended recommendations "
    "comment comments commentlist disqus replies reply respond widget pager pagination toolbar copyright contentinfo complementary dialog".split()
)
INSIDE_HEADER = frozenset(["header"])  # a page's header is not content, an article's is


LEAST = -2.0  # no token scores less,
LEAST_INLINE = -0.5  # and no inline tag or linked word less than this


class Page:
    """Tokens of a page: tags and text runs, each with its kind, whether it is set aside, and whether it is labelled content."""

    def __init__(self, html: str):
        self.kinds: list[str] = []
        self.weights: list[int] = []  # how often the kind counts: words of a text, 1 for a tag
        self.texts: list[str | None] = []  # None for a tag
        self.breaks: list[bool] = []  # a tag that ends a block
        self.aside: list[bool] = []
        self.content: list[bool] = []
        self.stack: list[tuple[str, bool, bool]] = []  # name, set aside, labelled content
        self.asides = self.contents = self.links = 0
        at = 0
        for m in TOKEN.finditer(html):
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            if m[3]:
                self._tag(m[3].lower(), bool(m[2]), m[4] or "")
            elif m[1]:
                self._add("raw", 1, None, m[1].lower() not in INLINE)
        if at < len(html):
            self._text(html[at:])

    def _add(self, kind: str, weight: int, text: str | None, breaks: bool = False) -> None:
        self.kinds.append(kind)
        self.weights.append(weight)
        self.texts.append(text)
        self.breaks.append(breaks)
        self.aside.append(self.asides > 0)
        self.content.append(self.contents > 0)

    def _text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        words = len(text.split())
        kind = "word aside" if self.asides else "word link" if self.links else "word"
        self._add(kind if words else "space", words or 1, text)

    def _pop(self) -> None:
        name, aside, content = self.stack.pop()
        self.asides -= aside
        self.contents -= content
        self.links -= name == "a"

    def _tag(self, name: str, closing: bool, attributes: str) -> None:
        shown = name if name in KNOWN else "other"
        if closing:
            if any(open_name == name for open_name, _, _ in reversed(self.stack)):
                while self.stack[-1][0] != name:
                    self._pop()
                aside = self.stack[-1][1]
                self._pop()
                self._add(f"/{shown}" + " marked" * aside, 1, None, name not in INLINE)
            else:
                self._add(f"/{shown}", 1, None, name not in INLINE)
            return
        if name not in INLINE:  # a block cannot stand in a paragraph that was left open, nor an item in an item
            while self.stack and (self.stack[-1][0] in ("p", "a") or self.stack[-1][0] == name == "li"):
                self._pop()
        aside = name in ASIDE or (name in INSIDE_HEADER and not self.contents) or ("=" in attributes or "hidden" in attributes) and self._marked(attributes)
        aside = aside and name not in CONTENT and name not in ("html", "body")
        kind = f"{shown} marked" if aside else shown
        if name in VOID:
            self._add(kind, 1, " " if name == "br" else None, name not in INLINE)
            return
        self._add(kind, 1, None, name not in INLINE)
        content = name in CONTENT
        self.stack.append((name, aside, content))
        self.asides += aside
        self.contents += content
        self.links += name == "a"

    def _marked(self, attributes: str) -> bool:
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if not MARKS.isdisjoint(PART.findall(value)):
                return True
        return False


def count_kinds(page: Page) -> tuple[Counter, Counter]:
    """How often each kind stands inside and outside the labelled content; nothing for a page without any."""
    inside, outside = Counter(), Counter()
    if any(page.content):
        for kind, weight, content in zip(page.kinds, page.weights, page.content, strict=True):
            (inside if content else outside)[kind] += weight
    return inside, outside


def weights(inside: dict[str, int], outside: dict[str, int]) -> dict[str, float]:
    """Scores by kind. Plain words are held above zero and tags below it, both within bounds, so that a kind
    that no labelled page has inside its content (a link, say) costs a few words and not the paragraph.

    A few made-up counts for the names that the standard itself calls content or not keep the scores sensible
    where no page is labelled.
    """
    a, b = Counter(inside), Counter(outside)
    for kind, k, other in (("word", 200, 20), ("p", 10, 1), ("/p", 10, 1), ("word link", 5, 20), ("word aside", 1, 200)):
        a[kind] += k
        b[kind] += other
    total_a, total_b = sum(a.values()) + 1, sum(b.values()) + 1
    out = {}
    for kind in {*a, *b, *KNOWN, *(f"/{k}" for k in KNOWN)}:
        score = log((a[kind] + 0.5) / total_a) - log((b[kind] + 0.5) / total_b)
        least = LEAST_INLINE if kind == "word link" or kind.removeprefix("/") in INLINE else LEAST
        out[kind] = min(1.0, max(0.1, score)) if kind == "word" else max(least, min(-0.01, score))
    return out | {"space": 0.0}


def best_run(page: Page, score: dict[str, float]) -> tuple[int, int]:
    """Bounds of the first shortest run of tokens with the highest positive sum; (0, 0) if none is positive.

    What is set aside costs its outer tags only: an advert amid an article, however long, does not split it.
    """
    best, span, now, start = 0.0, (0, 0), 0.0, 0
    for k, (kind, weight, aside) in enumerate(zip(page.kinds, page.weights, page.aside, strict=True)):
        if aside:
            continue
        if now <= 0:
            now, start = 0.0, k
        now += score.get(kind, LEAST) * weight
        if now > best:
            best, span = now, (start, k + 1)
    return span


def main_text(html: str, score: dict[str, float]) -> str:
    """Blocks of the best run, one line each: references decoded, white space runs as one space."""
    page = Page(html)
    start, end = best_run(page, score)
    blocks, block = [], []
    for k in range(start, end):
        text = page.texts[k]
        if text is not None and not page.aside[k]:
            block.append(text)
        elif page.breaks[k] and block:
            blocks.append(" ".join("".join(block).split()))
            block = []
    blocks.append(" ".join("".join(block).split()))
    return "\n".join(filter(None, blocks))


def learn(pages: DataFrame, most: int = 2000, id_col: str = "page_id", html_col: str = "html") -> dict[str, float]:
    """Scores from at most ``most`` pages, those with the smallest hashes of their ids."""
    picked = pages.select(F.col(id_col).alias("page")).filter("page is not null").distinct().orderBy(F.xxhash64(F.lit(2), "page"), "page").limit(most)

    def step(batch):
        inside, outside = Counter(), Counter()
        for html in batch.column(0):
            a, b = count_kinds(Page(html.as_py()))
            inside += a
            outside += b
        kinds = sorted({*inside, *outside})
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()), pa.array([outside[k] for k in kinds], pa.int64())], names=["kind", "inside", "outside"])

    some = pages.filter(F.col(html_col).isNotNull()).select(F.col(id_col).alias("page"), F.col(html_col).alias("html")).join(F.broadcast(picked), "page").select("html")
    counted = map_batches(some, "kind string, inside long, outside long", lambda: step).groupBy("kind").agg(F.sum("inside").alias("a"), F.sum("outside").alias("b")).collect()
    return weights({r["kind"]: r["a"] for r in counted}, {r["kind"]: r["b"] for r in counted})


def extract(pages: DataFrame, score: dict[str, float], id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, url, text`` for every row; a null or empty page has an empty text, repeated rows stay."""

    def step(batch):
        texts = [main_text(h.as_py(), score) for h in batch.column(2)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return map_batches(rows, "page_id long, url string, text string", lambda: step)
