"""Main text of web pages by maximum-scoring subsequence.

A page becomes a sequence of words and tags.  Each token has a weight: a
word's says how much more often words with its surroundings (nearest block
element, link, inside or outside of a marked article) stand in the content of
labelled pages than elsewhere, a tag's is that of its name and never above
zero.  One scan finds the contiguous region with the largest sum, and the
region's blocks, without the elements that are never content, are the text.

``fit`` takes as labelled pages those that mark their content by ``article``
or ``main``, at most ``max_pages`` of them (those whose ``xxhash64(key)``
come first); their tokens are counted on the executors, and each feature that
``LEAST_TOKENS`` of them have gets a weight: a few hundred for the elements of
HTML, up to three more for each other element name in frequent use.  Without
any labelled page, ``PLAIN`` weights hold.  Reading a page takes time in
proportion to it, however deep its elements stand.  ``extract`` adds ``text`` in one narrow pass.  Null and empty pages
and pages without content give the empty string.  Malformed pages (unclosed
or stray tags, cut ends) are read as browsers read them in the main points:
a paragraph ends where the next block begins, unclosed scripts, styles and
comments reach to the end.  Rows keep their other columns; a column named like the new
one is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtok.llm.flat import byte_rows, row_slices, same_rows, with_columns

MAX_PAGES = 4000
#: Tokens of labelled pages that must have a feature before it has a weight of its own.
LEAST_TOKENS = 20

# Element names of HTML.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "head", "object", "canvas", "math", "noframes", "audio", "video")
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
BLOCK = frozenset(("address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
                   "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
                   "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"))
CONTENT = ("article", "main")
# elements that are never part of the main text, by name and by a word of their class, id or role
ASIDE = frozenset(("nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu"))
ASIDE_WORDS = frozenset(("ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
                         "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu",
                         "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "related", "replies",
                         "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"))

# a quoted value may hold a bracket; a quote that isn't one means nothing
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)>|<[!?/][^>]*>", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
MARK, END = re.compile(r"<(?:article|main)\b", re.I), re.compile(r"</([a-zA-Z][^\s/>]*)")
RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}

#: Weights where no page is labelled.
PLAIN = {"word": 1.0, "word in a link": -1.0, "tag": -3.25}


def _marked_aside(attributes: str) -> bool:
    for found in NAMES.findall(attributes):
        for word in "".join(found).lower().split():
            if word in ASIDE_WORDS or (parts := re.split(r"[-_]", word))[0] in ASIDE_WORDS and len(parts) < 3:
                return True
    return False


class Open:
    """The open elements of a page, with what is asked of them at hand: each
    step costs the same however many there are."""

    def __init__(self):
        self.stack: list[list] = []       # [name, aside, still open]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []       # places of open block elements
        self.inside = self.aside = self.links = 0

    def push(self, name: str, off: bool) -> None:
        at = len(self.stack)
        self.stack.append([name, off, True])
        self.places.setdefault(name, []).append(at)
        if name in BLOCK:
            self.blocks.append(at)
        self._count(name, off, 1)

    def _count(self, name: str, off: bool, n: int) -> None:
        self.inside += n * (name in CONTENT)
        self.links += n * (name == "a")
        self.aside += n * off

    def _end(self, at: int) -> None:
        name, off, _ = self.stack[at]
        self.stack[at][2] = False
        self.places[name].pop()
        if self.blocks and self.blocks[-1] == at:
            self.blocks.pop()
        self._count(name, off, -1)

    def drop_to(self, name: str) -> None:
        """The innermost ``name`` ends, and all within it."""
        at = self.places[name][-1]
        while len(self.stack) > at:
            if self.stack[-1][2]:
                self._end(len(self.stack) - 1)
            self.stack.pop()

    def close(self, name: str) -> None:
        if self.places.get(name):
            at = self.places[name][-1]
            # an inline element's end doesn't close the blocks within it
            if name in BLOCK or not self.blocks or self.blocks[-1] < at:
                self.drop_to(name)
            else:
                self._end(at)

    def last(self) -> str:
        while self.stack and not self.stack[-1][2]:
            self.stack.pop()
        return self.stack[-1][0] if self.stack else ""

    def block(self) -> str:
        return self.stack[self.blocks[-1]][0] if self.blocks else ""


def tokens(page: str):
    """(kind, name or text, feature, whether in a marked article, whether never content) in order; kind: text or tag.
    An element named for the side that holds the article isn't taken as one."""
    marks = [m.start() for m in MARK.finditer(page)]
    marked, open_, ends = bool(marks), Open(), None
    endless: set[str] = set()  # raw elements that no end follows any more
    at, size, last = 0, len(page), page.rfind(">") + 1

    def side() -> str:
        return "in " if open_.inside else "out " if marked else ""

    def holds_article(at: int, name: str) -> bool:
        """Whether an article begins before the element ends."""
        nonlocal ends
        i = bisect_left(marks, at)
        if i == len(marks):
            return False
        if ends is None:
            ends = {}
            for m in END.finditer(page):
                ends.setdefault(m[1].lower(), []).append(m.start())
        own = ends.get(name, [])
        k = bisect_left(own, at)
        return k == len(own) or marks[i] < own[k]

    while at < size:
        m = TOKEN.search(page, at, last) if at < last else None
        end = m.start() if m else size
        if end > at:
            yield "text", page[at:end], f"{side()}{open_.block()}{' a' if open_.links else ''}", open_.inside > 0, open_.aside > 0
        if not m:
            return
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                return
            continue
        close, attributes = m[1], m[3]
        if close:
            open_.close(name)
        else:
            alone = attributes.rstrip().endswith("/")
            if name in RAW and not alone:
                if name != "head":
                    over = None if name in endless else RAW_END[name].search(page, at)
                    if over is None:
                        endless.add(name)
                    at = over.end() if over else size if name in ("script", "style", "textarea", "title") else at
                    yield "tag", name, side() + name, open_.inside > 0, True
                    continue
            if name in BLOCK:
                # a paragraph ends where a block begins, and items end each other
                if open_.block() == "p":
                    open_.drop_to("p")
                same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}.get(name, ())
                if same and open_.last() in same:
                    open_.drop_to(open_.last())
            if name not in VOID and not alone:
                off = name in ASIDE or (name not in CONTENT and _marked_aside(attributes) and not (marked and not open_.inside and holds_article(m.end(), name)))
                open_.push(name, off)
        yield "tag", name, side() + name, open_.inside > 0, open_.aside > 0


def _features(kind: str, value: str, feature: str, off: bool) -> tuple[str, int]:
    if kind == "tag":
        return f"tag {feature}", 1
    return f"word {feature}{' aside' if off else ''}", len(value.split())


def weight(weights: dict[str, float], kind: str, value: str, feature: str, off: bool) -> float:
    name, n = _features(kind, value, feature, off)
    w = weights.get(name)
    if w is None:
        if feature.startswith("in "):  # the page says so itself
            w = 1.0 if kind == "text" and not off else -0.05
        elif kind == "tag":
            w = PLAIN["tag"]
        else:
            w = -2.0 if off else PLAIN["word in a link" if feature.endswith(" a") or feature.startswith("out ") else "word"]
    return w * n


def best_region(weights: list[float]) -> tuple[int, int]:
    """First and past the last of the run with the largest sum; an empty one if none is above zero."""
    best, total, start, region = 0.0, 0.0, 0, (0, 0)
    for i, w in enumerate(weights):
        if total <= 0:
            total, start = 0.0, i
        total += w
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str, weights: dict[str, float]) -> str:
    found = list(tokens(page))
    a, b = best_region([weight(weights, t[0], t[1], t[2], t[4]) for t in found])
    blocks: list[list[str]] = [[]]
    for kind, value, _, _, off in found[a:b]:
        if kind == "text":
            if not off:
                blocks[-1].append(value)
        elif value == "br":
            blocks[-1].append(" ")
        elif value in BLOCK:
            blocks.append([])
    texts = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def _batches(batches, at: int):
    for batch in batches:
        column = batch.column(at)
        _, offs = byte_rows(column)
        for lo, hi in row_slices(offs, 1 << 21):
            yield batch.slice(lo, hi - lo), column.slice(lo, hi - lo).to_pylist()


def fit(pages: DataFrame, key: str = "page_id", html_col: str = "html", max_pages: int = MAX_PAGES) -> dict[str, float]:
    labelled = pages.where(F.col(html_col).rlike(r"(?i)<(article|main)\b"))
    chosen = labelled.select(F.col(key).alias("_key")).orderBy(F.xxhash64("_key"), "_key").limit(max_pages).distinct()
    sample = labelled.select(F.col(key).alias("_key"), F.col(html_col).alias("_html")).join(F.broadcast(chosen), "_key").select("_html")

    def run(batches):
        counts: Counter = Counter()
        for _, texts in _batches(batches, 0):
            for page in texts:
                for kind, value, feature, inside, off in tokens(page):
                    name, n = _features(kind, value, feature, off)
                    counts[name, inside] += n  # asides in an article are cut out, they don't end it
                    name, n = _features(kind, value, re.sub("^(in|out) ", "", feature), off)  # as if no article were marked
                    counts[name, inside and not off] += n
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in counts], pa.string()), pa.array([i for _, i in counts], pa.bool_()),
                                          pa.array(list(counts.values()), pa.int64())], ["name", "inside", "n"])

    each = sample.mapInArrow(run, "name string, inside boolean, n long").groupBy("name").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("yes"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("no"))
    weights = {}
    for r in each.where(F.col("yes") + F.col("no") >= LEAST_TOKENS).collect():
        odds = math.log((r.yes + 1) / (r.no + 1))
        weights[r.name] = min(odds, -0.05) if r.name.startswith("tag ") else odds
    return weights


def extract(pages: DataFrame, weights: dict[str, float], html_col: str = "html", out_col: str = "text") -> DataFrame:
    pages = pages.drop(out_col)
    shared, at = pages.sparkSession.sparkContext.broadcast(weights), pages.columns.index(html_col)

    def run(batches):
        for rows, texts in _batches(batches, at):
            yield with_columns(rows, **{out_col: pa.array([main_text(p, shared.value) if p else "" for p in texts], pa.string())})

    return pages.mapInArrow(run, same_rows(pages.schema, T.StructField(out_col, T.StringType())))
