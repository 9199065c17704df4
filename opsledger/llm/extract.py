"""HTML extraction: flat text blocks, classified by a decision tree trained on a small labelled table.

A page becomes a flat list of blocks, cut at block-level tags. A block is described by its word count and link
density, those of its neighbours, whether it stands in an article, a heading, a page-frame element (nav, footer,
aside, form ...) or an element whose class, id or role names such a part, and whether the page marks its article at all (article, main
or a first heading). Names are two features: ``hinted`` inside articles, for reader comments and for hidden elements, and ``named``
elsewhere, where a name says little: it does not count on elements that come to hold the marked article nor in
compounds like has-sidebar or sidebar-wrap, and on pages that mark no article words and neighbours decide. The tree is trained on the blocks of
``extract_pages.PAGES``, where ``keep`` marks the main text. Scripts, styles, comments, markup and titles never give
text; character references are decoded; white space inside a block becomes one space; blocks are joined by an empty
line.

Defined cases: null and empty html give the empty text; a tag cut off at the end of a page is dropped; tags that
are not closed end with their parent, but scripts, styles, titles, text areas and frames run to the end of the page; text of any length is read once, in linear time; repeated rows give equal rows;
an empty table gives none. Extra columns do not matter.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .extract_pages import PAGES
from .shared import small_batches, table

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?>=\s*(?>\"[^\"]*\"|'[^']*')|[^>])*+)(>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# elements whose content is not text of the page
RAW = {"script", "style", "title", "textarea", "template", "noscript", "iframe", "svg", "math", "select", "object", "canvas"}
TO_THE_END = {"script", "style", "title", "textarea", "iframe"}  # hold raw text, also without an end tag
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
FRAME = {"nav", "footer", "aside", "form", "header", "menu", "button", "dialog", "fieldset", "label"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|notification|alert|sidebar|"
    r"side|menu|nav\w*|comments?|commentlist|replies|reply|respond|disqus|footer|header|masthead|share|social|related|"
    r"recommend\w*|newsletter|subscribe|signup|login|breadcrumbs?|pagination|popup|modal|widget|toolbar|complementary|"
    r"contentinfo|search|hidden|copyright|legal)(?:$|[\s_-])", re.IGNORECASE)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|replies|reply|respond|disqus)(?:$|[\s_-])", re.IGNORECASE)
COMPOUND = re.compile(r"(?:^|[_-])(?:has|no|with)[_-]|[_-]wrap(?:per)?$", re.IGNORECASE)  # says something of a page's layout
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_frame", "hinted", "named",
            "in_article", "heading", "marked")


@dataclass
class Block:
    text: str
    words: int
    links: float
    in_frame: bool
    hinted: bool
    named: bool
    in_article: bool
    heading: bool
    keep: bool
    marked: bool = False


@dataclass
class _Open:
    """Counts of the open elements that describe a block."""
    stack: list = field(default_factory=list)
    names: Counter = field(default_factory=Counter)
    flags: Counter = field(default_factory=Counter)
    named: list = field(default_factory=list)  # numbers of open elements whose hint goes if they hold an article
    withdrawn: set = field(default_factory=set)
    pushed: int = 0
    marked: bool = False

    def push(self, name: str, attributes: str) -> None:
        marks = []
        inside = self.flags["article"] > 0
        if name in ("article", "main", "h1") and not inside:
            self.marked |= name != "h1" or not self.flags["frame"]
            self.withdrawn.update(self.named)
            self.named.clear()
        self.pushed += 1
        if name in ("article", "main"):
            marks.append("article")
        if name in FRAME and not (name == "header" and inside):
            marks.append("frame")
        if name in HEADINGS:
            marks.append("heading")
        if attributes.strip():
            pairs = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
            words = " ".join(pairs.get(k, "") for k in ("class", "id", "role", "aria-label"))
            words = " ".join(w for w in words.split() if not COMPOUND.search(w))
            if name not in ("body", "html"):
                if ("hidden" in pairs or "display:none" in pairs.get("style", "").replace(" ", "") or COMMENTS.search(words)
                        or inside and name != "main" and HINT.search(words)):
                    marks.append("hint")
                elif name not in ("article", "main", "h1") and HINT.search(words):
                    self.named.append(self.pushed)
            if "keep" in pairs:
                marks.append("keep")
        self.stack.append((name, marks, self.pushed))
        self.names[name] += 1
        self.flags.update(marks)

    def pop(self, name: str) -> None:
        if not self.names[name]:
            return
        while True:
            last, marks, number = self.stack.pop()
            if self.named and self.named[-1] == number:
                self.named.pop()
            self.names[last] -= 1
            self.flags.subtract(marks)
            if last == name:
                return


def blocks(html: str | None) -> list[Block]:
    out: list[Block] = []
    if not html:
        return out
    opened, parts, linked, at = _Open(), [], 0, 0
    innermost: list[int] = []  # per block, the number of the innermost open element that may lose its hint, or 0
    endless: set[str] = set()

    def cut() -> None:
        nonlocal linked
        words = "".join(parts).split()
        if words:
            flags = opened.flags
            out.append(Block(" ".join(words), len(words), min(1.0, linked / len(words)), flags["frame"] > 0,
                             flags["hint"] > 0, False, flags["article"] > 0, flags["heading"] > 0, flags["keep"] > 0))
            innermost.append(opened.named[-1] if opened.named else 0)
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        text = references.unescape(text)
        parts.append(text)
        if opened.names["a"]:
            linked += len(text.split())

    while True:
        tag = TOKEN.search(html, at)
        if tag is None:
            add(html[at:])
            break
        if tag.start() > at:
            add(html[at:tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            cut()
        elif name == "br":
            parts.append(" ")
        if tag[1]:
            opened.pop(name)
        elif name in RAW:
            if not tag[3].rstrip().endswith("/") and name not in endless:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                if end:
                    at = end.end()
                elif name in TO_THE_END:
                    at = len(html)
                else:
                    endless.add(name)  # no later one has an end tag either
        elif name not in VOID and not (tag[3].rstrip().endswith("/") and name in INLINE):
            if opened.names["p"] and name not in INLINE:
                opened.pop("p")  # a paragraph ends where another block begins
            if name in ("li", "option") and opened.stack and opened.stack[-1][0] == name:
                opened.pop(name)
            opened.push(name, tag[3])
    cut()
    for block, number in zip(out, innermost, strict=True):
        block.named = number > 0 and number not in opened.withdrawn
        block.marked = opened.marked
    return out


def features(page: list[Block]) -> np.ndarray:
    rows = np.array([(b.words, b.links, b.in_frame, b.hinted, b.named, b.in_article, b.heading, b.marked) for b in page],
                    float).reshape(-1, 8)
    edge = np.zeros((1, 2))
    near = rows[:, :2]
    return np.hstack([near, np.vstack([edge, near[:-1]])[:len(near)], np.vstack([near[1:], edge])[:len(near)], rows[:, 2:]])


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10, least: int = 1):
    """A decision tree by Gini impurity: (feature, threshold, low side, high side), or the leaf's answer."""
    answer = bool(y.mean() >= 0.5)
    if depth == 0 or y.min() == y.max():
        return answer
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            if min(low.sum(), (~low).sum()) < least:
                continue
            impurity = sum(s.sum() * y[s].mean() * (1 - y[s].mean()) for s in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, cut, low
    if best is None:
        return answer
    _, f, cut, low = best
    return f, float(cut), grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def decide(tree, row: np.ndarray) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def train(pages=PAGES):
    known = [blocks(p) for p in pages]
    x = np.vstack([features(p) for p in known])
    return grow(x, np.array([b.keep for p in known for b in p], float))


def main_text(tree, html: str | None) -> str:
    page = blocks(html)
    if not page:
        return ""
    return "\n\n".join(b.text for b, row in zip(page, features(page), strict=True) if decide(tree, row))


def extract(pages: DataFrame, column: str = "html"):
    """Text column of the main text of an html column."""
    small_batches(pages.sparkSession)
    tree = train()

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(tree, page) for page in batch], dtype=object)

    return texts(F.col(column).cast("string"))


def op3_extract(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return pages.select("page_id", "url", extract(pages).alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
