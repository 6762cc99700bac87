"""Main text of web pages from flat text blocks and a decision tree.

A page is read as a flat list of text blocks, parted wherever an element that starts a new line begins or ends. A block
has its word count and link density, those of its neighbours in the same surroundings, and what these say: elements and roles tell an
article, a part of the site, or neither; names of classes are a hint only, clear or doubtful. A small decision tree,
trained on the labelled table below, weighs all of it and tells article from the rest. The text of a page is its article
blocks, one per line.

Scripts, styles, comments and other contents never shown are passed over, to the end of the page if they are not closed.
Null and empty pages, and pages without article, give an empty text. Pages are treated one by one and whole, so ties,
repeated rows and length do not matter; an empty table gives an empty one. All columns are kept; an old column of the name
of the result is replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import need

# What the element names and attributes of HTML mean.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template textarea title svg math iframe object select button canvas audio video map datalist".split())
SITE = frozenset("nav footer aside form menu dialog".split())
ARTICLE = frozenset("article main".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 dt dd".split())
SITE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promoted promotion sponsor sponsored sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices alert popup modal overlay comment comments reply replies "
    "respond disqus share sharing social related recommended feedback newsletter subscribe subscription login signup search widget widgets toolbar "
    "masthead pagination pager tags skip copyright legal disclaimer topbar".split())
ARTICLE_WORDS = frozenset("article post entry story content main body text".split())
# Words that say nothing of the contents: a name made of these and site words is a clear hint, any other one with a site word is doubtful.
PLAIN_WORDS = frozenset(
    "list lists item items box boxes area section wrap wrapper container inner outer bar block blocks link links group row col column "
    "columns contents left right top bottom site page global primary secondary header head foot title icon icons button buttons form "
    "posts articles stories entries panel panels module holder thread count meta info user author more first last js id".split()) | ARTICLE_WORDS
SITE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# What elements say, and what names of classes and ids hint at.
NEITHER, ARTICLE_PART, SITE_PART = 0, 1, 2
NO_HINT, ARTICLE_HINT, DOUBTFUL, SITE_HINT = 0, 1, 2, 3

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>|<[!?/][^>]*(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    part: int
    heading: int
    hint: int = NO_HINT


def hint_of(names: list[str]) -> int:
    """What the names of a class or id attribute hint at."""
    seen = set()
    for name in names:
        words = set(WORD.findall(name))
        if words & SITE_WORDS or "header" in words:
            seen.add(SITE_HINT if words <= SITE_WORDS | PLAIN_WORDS else DOUBTFUL)
        elif words & ARTICLE_WORDS and words <= PLAIN_WORDS:
            seen.add(ARTICLE_HINT)
    if SITE_HINT in seen:
        return SITE_HINT
    return ARTICLE_HINT if ARTICLE_HINT in seen else DOUBTFUL if seen else NO_HINT


def surroundings(name: str, rest: str, outer: tuple[int, int]) -> tuple[int, int] | None:
    """What an element makes of its contents: part and hint; None: they are never shown."""
    names, role = [], ""
    for m in ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return None
        if key in ("class", "id"):
            names += value.split()
        elif key == "role":
            role = value.strip()
    part, hint = outer
    begins = name in ARTICLE or role in ("main", "article")
    if part == SITE_PART or name in SITE or role in SITE_ROLES:
        return SITE_PART, hint
    if part == NEITHER and (begins or name in ("html", "body")):
        # An article begins anew whatever is around it, and what these are called says nothing of their contents.
        return ARTICLE_PART if begins else part, NO_HINT
    if part == NEITHER and name == "header":
        return SITE_PART, hint
    own = hint_of(names)
    # A heading's place inside an article is part of it.
    if part == ARTICLE_PART and name in ("header", "h1", "h2", "h3", "h4", "h5", "h6"):
        own = NO_HINT
    return part, max(hint, own) if SITE_HINT in (hint, own) else own or hint


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in its order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    opened: list[tuple[str, tuple[int, int]]] = []
    count: Counter[str] = Counter()

    def close(k: int) -> None:
        """Close all elements from the k-th on."""
        for n, _ in opened[k:]:
            count[n] -= 1
        del opened[k:]

    def part() -> tuple[int, int]:
        return opened[-1][1] if opened else (NEITHER, NO_HINT)

    def flush() -> None:
        nonlocal linked
        if parts:
            words = "".join(parts).split()
            if words:
                heading = any(n in ("h1", "h2", "h3", "h4", "h5", "h6") for n, _ in opened[-3:])
                out.append(Block(" ".join(words), len(words), min(linked, len(words)), part()[0], int(heading), part()[1]))
        parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if count["a"]:
            linked += len(text.split())

    at = 0
    for m in iter(lambda: TOKEN.search(page, at), None):
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name, ending, rest = name.lower(), bool(m["end"] or m["end2"]), m["rest"] or m["rest2"] or ""
        if name == "br" or name in INLINE and name in EMPTY:
            parts.append(" ")
            continue
        if name not in INLINE:
            flush()
        if ending:
            for k in range(len(opened) - 1, -1, -1) if count[name] else ():
                if opened[k][0] == name:
                    close(k)
                    break
                if name in INLINE and opened[k][0] not in INLINE:
                    break  # a stray end inside a block does not close what is around it
            continue
        if name not in INLINE:
            # A new block ends an open paragraph and the inline elements left open in it.
            while opened and (opened[-1][0] in INLINE or opened[-1][0] in CLOSED_BY_BLOCK):
                close(len(opened) - 1)
            if name == "li" and opened and opened[-1][0] == "li":
                close(len(opened) - 1)
        if name in EMPTY or rest.endswith("/") and name in HIDDEN:
            continue
        inner = surroundings(name, rest, part())
        if name in HIDDEN or inner is None:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE)
            found = stop.search(page, at)
            at = found.end() if found else len(page)
            continue
        if name == "a" and count["a"] and opened[-1][0] == "a":
            close(len(opened) - 1)
        opened.append((name, inner))
        count[name] += 1
    if at < len(page):
        say(page[at:])
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """Per block: part, hint, heading, words and link density; words and link density of the blocks before and after.

    Neighbours are blocks of the same surroundings: a menu after an article says nothing of its last line."""
    own = np.array([[b.words, b.linked / b.words] for b in found], dtype=np.float64).reshape(-1, 2)
    place = np.array([[b.part, b.hint] for b in found], dtype=np.float64).reshape(-1, 2)
    same = (place[1:] == place[:-1]).all(axis=1)[:, None]
    edge = np.zeros((min(1, len(found)), 2))
    around = np.hstack([np.vstack([edge, own[:-1] * same]), np.vstack([own[1:] * same, edge])])
    return np.hstack([place, np.array([[b.heading] for b in found], dtype=np.float64).reshape(-1, 1), own, around])


# The labelled table: pages as runs of blocks (part, hint, heading, words, linked words, belongs to the article).
# Parts: 0 neither, 1 inside an article, 2 inside a part of the site. Hints: 1 article, 2 doubtful, 3 site.
LABELLED = (
    ((2, 0, 0, 1, 1, 0), (2, 0, 0, 1, 1, 0), (2, 0, 0, 2, 2, 0), (2, 0, 0, 8, 0, 0), (1, 0, 1, 7, 0, 1), (1, 0, 0, 60, 0, 1), (1, 0, 0, 1, 0, 1),
     (1, 0, 0, 35, 2, 1), (1, 0, 0, 4, 0, 1), (2, 0, 0, 12, 0, 0)),
    ((2, 0, 0, 3, 3, 0), (1, 0, 1, 4, 0, 1), (1, 0, 0, 2, 0, 1), (1, 0, 0, 110, 6, 1), (1, 0, 0, 6, 6, 1), (1, 0, 0, 48, 0, 1), (1, 3, 0, 40, 0, 0),
     (1, 3, 0, 25, 3, 0), (1, 3, 0, 5, 1, 0)),
    ((2, 0, 0, 30, 2, 0), (0, 3, 1, 3, 0, 0), (1, 0, 0, 12, 0, 1), (1, 0, 0, 9, 0, 1), (1, 0, 0, 1, 0, 1), (0, 3, 0, 60, 0, 0), (0, 3, 0, 3, 0, 0)),
    ((0, 0, 0, 1, 1, 0), (0, 0, 0, 1, 1, 0), (0, 0, 0, 2, 2, 0), (0, 0, 1, 6, 0, 1), (0, 0, 0, 45, 0, 1), (0, 0, 0, 80, 3, 1), (0, 0, 0, 30, 0, 1),
     (0, 0, 0, 4, 0, 0), (0, 0, 0, 3, 3, 0)),
    ((0, 0, 0, 2, 2, 0), (0, 0, 0, 5, 5, 0), (0, 0, 0, 28, 0, 1), (0, 0, 0, 14, 0, 1), (0, 0, 0, 52, 1, 1), (0, 0, 0, 6, 4, 0), (0, 0, 0, 7, 7, 0)),
    ((0, 0, 0, 3, 3, 0), (0, 0, 0, 4, 0, 0), (0, 0, 0, 3, 3, 0), (0, 0, 0, 2, 2, 0), (0, 0, 1, 5, 0, 1), (0, 0, 0, 33, 0, 1), (0, 0, 0, 70, 0, 1),
     (0, 0, 0, 12, 12, 0), (0, 0, 0, 9, 9, 0)),
    ((2, 0, 0, 18, 0, 0), (2, 0, 0, 90, 0, 0), (1, 0, 1, 9, 0, 1), (1, 0, 1, 3, 0, 1), (1, 0, 0, 22, 0, 1), (1, 0, 0, 3, 3, 1), (1, 0, 0, 16, 0, 1)),
    ((0, 0, 0, 6, 6, 0), (0, 0, 0, 1, 0, 0), (0, 0, 0, 6, 6, 0), (2, 0, 0, 14, 1, 0), (0, 0, 0, 40, 0, 1), (0, 0, 0, 11, 0, 1), (0, 0, 0, 38, 2, 1),
     (0, 3, 0, 33, 0, 0), (0, 0, 0, 2, 2, 0), (0, 0, 0, 3, 0, 0)),
    ((2, 0, 0, 2, 2, 0), (2, 0, 0, 1, 1, 0), (1, 0, 1, 5, 5, 1), (1, 0, 0, 8, 1, 1), (1, 0, 0, 10, 4, 1), (1, 0, 0, 20, 6, 1), (1, 0, 0, 3, 2, 1),
     (1, 0, 0, 40, 20, 1), (1, 0, 0, 2, 1, 1), (0, 3, 0, 20, 0, 0), (0, 3, 0, 6, 0, 0), (0, 3, 0, 45, 0, 0)),
    ((2, 0, 0, 50, 0, 0), (1, 0, 0, 15, 3, 1), (1, 0, 0, 5, 1, 1), (1, 0, 0, 90, 30, 1), (1, 0, 0, 4, 4, 1), (1, 0, 0, 7, 2, 1), (1, 3, 0, 70, 0, 0),
     (1, 3, 0, 9, 0, 0), (1, 3, 0, 120, 0, 0), (1, 3, 0, 2, 0, 0)),
    ((0, 0, 0, 1, 1, 0), (0, 0, 0, 2, 2, 0), (0, 0, 0, 1, 1, 0), (0, 1, 1, 5, 0, 1), (0, 1, 0, 40, 0, 1), (0, 1, 0, 2, 0, 1), (0, 1, 0, 55, 4, 1), (0, 1, 0, 1, 0, 1),
     (0, 1, 0, 30, 5, 1), (0, 1, 0, 25, 4, 1), (0, 0, 0, 5, 0, 0), (0, 0, 0, 2, 2, 0)),
    ((2, 0, 0, 1, 1, 0), (0, 0, 1, 3, 0, 1), (0, 0, 0, 12, 1, 1), (0, 0, 0, 30, 0, 1), (0, 0, 0, 3, 0, 1), (0, 0, 0, 60, 6, 1), (0, 0, 0, 8, 8, 0), (0, 0, 0, 6, 6, 0),
     (2, 0, 0, 8, 0, 0)),
    # Names that only sound like the site, an article's own short last line, and lists of links in an article.
    ((1, 0, 1, 6, 0, 1), (1, 2, 0, 70, 2, 1), (1, 2, 0, 24, 0, 1), (1, 2, 0, 5, 0, 1), (1, 0, 0, 30, 0, 1), (1, 0, 0, 4, 0, 1)),
    ((1, 0, 0, 44, 1, 1), (1, 0, 0, 3, 0, 1), (2, 0, 0, 1, 1, 0), (2, 0, 0, 2, 2, 0)),
    ((1, 0, 0, 1, 0, 1), (2, 0, 0, 1, 1, 0)),
    ((1, 0, 0, 52, 0, 1), (1, 2, 0, 3, 3, 0), (1, 2, 0, 2, 2, 0), (1, 2, 0, 4, 4, 0)),
    ((1, 0, 0, 38, 0, 1), (1, 0, 0, 7, 7, 0), (1, 0, 0, 6, 6, 0), (1, 0, 0, 8, 8, 0), (1, 0, 0, 5, 5, 0)),
    ((1, 0, 1, 5, 0, 1), (1, 0, 0, 90, 4, 1), (1, 0, 0, 6, 6, 0), (1, 0, 0, 9, 9, 0), (2, 0, 0, 3, 3, 0)),
    ((0, 2, 0, 60, 0, 1), (0, 2, 0, 31, 1, 1), (0, 2, 0, 9, 0, 1), (0, 2, 0, 3, 3, 0), (0, 2, 0, 2, 2, 0)),
)


@dataclass
class Node:
    value: int
    column: int = -1
    bound: float = 0.0
    low: Node | None = field(default=None, repr=False)
    high: Node | None = field(default=None, repr=False)


def grow(x: np.ndarray, y: np.ndarray, depth: int, least: int = 2) -> Node:
    """Binary tree by Gini impurity; ties go to the first column and the smallest bound."""
    node = Node(int(2 * y.sum() >= len(y)))
    if depth == 0 or y.min() == y.max():
        return node

    def impurity(v: np.ndarray) -> float:
        return 2 * v.mean() * (1 - v.mean()) * len(v)

    best = impurity(y) - 1e-9
    for column in range(x.shape[1]):
        values = np.unique(x[:, column])
        for bound in (values[1:] + values[:-1]) / 2:
            low = x[:, column] <= bound
            if min(low.sum(), (~low).sum()) >= least and (got := impurity(y[low]) + impurity(y[~low])) < best:
                best, node.column, node.bound = got, column, float(bound)
    if node.column >= 0:
        low = x[:, node.column] <= node.bound
        node.low, node.high = grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)
    return node


@cache
def trained(depth: int = 7) -> Node:
    x = np.vstack([features([Block("", w, k, p, h, n) for p, n, h, w, k, _ in page]) for page in LABELLED])
    return grow(x, np.array([b[5] for page in LABELLED for b in page]), depth)


def belongs(tree: Node, row: np.ndarray) -> bool:
    while tree.column >= 0:
        tree = tree.low if row[tree.column] <= tree.bound else tree.high
    return bool(tree.value)


def main_text(page: str | None, tree: Node) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, row in zip(found, features(found)) if belongs(tree, row))


def extract(pages: DataFrame, column: str = "html", out: str = "text") -> DataFrame:
    """Add the main text. The tree, a few nodes, travels with the function."""
    need(pages, column)
    tree = trained()

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p, tree) for p in batch], dtype=object)

    return pages.withColumn(out, extracted(F.col(column).cast("string")))
