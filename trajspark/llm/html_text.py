"""Main text of web pages: flat text blocks classified by a decision tree (after Kohlschuetter, Fankhauser and Nejdl 2010).

A page is cut into blocks at its block-level tags; inline tags, and ``br`` as white space, stay inside a block. Features of a block are its
word count and link density, those of the blocks before and after it, and four marks of where it stands: inside an article, inside something
that isn't text (menu, form, advert, ...) within the article or outside any, in an article that itself stands aside (a sidebar's teaser),
and whether it is a heading. The tree is grown on ``LABELLED``, a small table of labelled blocks. Blocks that it accepts are the main text.

Scripts, styles, comments, titles, buttons and the like never make blocks. The whole page is read; nothing is cut off.

Defined results: null html is empty; a page without accepted blocks has an empty text and 0 characters; broken markup (unclosed
tags, quotes, comments, scripts) is read to the end of the page; a page of any length is read whole, in time that grows with its
length alone (nesting is kept as a running state, not looked through for each block); repeated rows are alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES_AT_ONCE = 256

# Names of HTML elements and roles, and words that sites use in class and id for parts of a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split())
SKIPPED = frozenset(
    "applet audio button canvas datalist embed iframe map math noembed noframes noscript object option script select style svg template "
    "textarea title video".split())
RAW = frozenset("script style textarea title iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset("article main".split())
CHROME = frozenset("nav header footer aside form menu dialog fieldset".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
ARTICLE_HINTS = frozenset("article articlebody content entry maincontent post story".split())
CHROME_HINTS = frozenset(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
    "disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo "
    "promotion recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe tags "
    "teaser toolbar widget".split())
ASIDE = frozenset("nav footer aside".split())
ASIDE_HINTS = frozenset("comment comments disqus recommended related replies sidebar teaser widget".split())
COMMENT_HINTS = frozenset("comment comments disqus replies reply respond".split())

# Labelled blocks. Each line: keep; words, link density; the same of the block before and after; inside an article,
# in something that isn't text inside the article or outside any, in an article that stands aside, heading.
LABELLED = """
1  60 .0   40 .0   55 .0  1 0 0 0
1  12 .0   80 .0   30 .0  1 0 0 0
1   1 .0   45 .0   60 .0  1 0 0 0
1   2 .0    1 .0    3 .0  1 0 0 0
1   3 .0    8 .0    0 .0  1 0 0 0
1   1 .0    0 .0    0 .0  1 0 0 0
1   9 .0    1 1.   50 .0  1 0 0 1
1  10 .0   12 .0   90 .0  1 0 0 1
1   4 .0   70 .0   80 .0  1 0 0 1
1   2 .0    6 .0   40 .0  1 0 0 1
1 150 .0   10 .0    9 .0  1 0 0 0
1  35 .2   60 .0   50 .1  1 0 0 0
1  25 .4   30 .1   44 .0  1 0 0 0
1   6 .5   50 .0   70 .0  1 0 0 0
1   5 1.   70 .0   60 .0  1 0 0 0
1  14 .9   40 .0   35 .1  1 0 0 0
1   7 .0   14 .0   11 .2  1 0 0 0
1  12 .0    9 .0    1 .0  1 0 0 0
1   6 .0   30 .0    0 .0  1 0 0 0
1  20 .0    3 .0    2 .0  1 0 0 0
1  10 .0    0 .0    0 .0  1 0 0 0
1   5 .0    2 .0    1 .0  1 0 0 0
1  15 .0   40 .0    3 1.  1 0 0 0
1   5 .0   40 .0    2 1.  1 0 0 0
1   4 .0    1 1.    2 .0  1 0 0 0
1  18 .3    2 .0    1 .0  1 0 0 0
0  11 .0   20 .0    2 .0  1 0 1 0
1 400 .0  300 .0  250 .0  1 0 0 0
1  10 .0    8 .0    2 1.  1 0 0 0
1   3 .0   12 .0    1 1.  1 0 0 0
1   8 .0   20 .0    5 1.  1 0 0 0
1   2 .0    0 .0    1 1.  1 0 0 0
1  12 .0    3 .0    9 1.  1 0 0 0
0  22 .0    5 .0   13 .1  1 0 1 0
0   8 .0   33 .0   21 .0  1 0 1 1
0   3 .0   25 .0    1 .0  1 0 1 0
0  40 .0   60 .0   55 .0  1 0 1 0
0   1 1.    1 1.    1 1.  1 0 0 0
0   3 1.    2 1.    4 1.  1 0 0 0
0   6 1.    5 1.    7 1.  1 0 0 0
0   4 1.    6 1.    0 .0  1 0 0 0
0   8 .9    9 1.    6 1.  1 0 0 0
0   2 1.    1 1.    1 1.  1 0 1 0
0  12 .0   60 .0   45 .0  1 1 0 0
0  30 .0   60 .0   45 .0  1 1 0 0
0  80 .0   10 .1   70 .0  1 1 0 0
0   3 .3   50 .0   12 .0  1 1 0 0
0   2 1.    3 1.    2 1.  1 1 0 0
0   5 .0   40 .0   30 .0  1 1 0 1
0   1 .0   25 .0    9 .0  1 1 1 0
0  45 .0   33 .0    4 1.  1 1 1 0
0   1 1.    1 1.    1 1.  0 1 0 0
0   1 1.    0 .0    1 1.  0 1 0 0
0   1 1.    1 1.    8 .0  0 1 0 0
0   8 .0    1 1.   10 .0  0 1 0 0
0  14 .0    1 1.    9 .0  0 1 0 0
0  50 .0   60 .0   40 .0  0 1 0 0
0  90 .0    3 1.   80 .0  0 1 0 0
0   6 .0   70 .0    0 .0  0 1 0 0
0  11 .2   55 .0    0 .0  0 1 0 0
0   4 .0   30 .0   25 .0  0 1 0 1
0  20 .5   20 .5   20 .5  0 1 0 0
1  50 .0   45 .0   60 .0  0 0 0 0
1  30 .1   70 .0   25 .0  0 0 0 0
1  18 .0   50 .0   44 .0  0 0 0 0
1   9 .0   40 .0   65 .0  0 0 0 0
1   5 .0   33 .0   52 .0  0 0 0 0
1   2 .0   60 .0   48 .0  0 0 0 0
1 120 .0    2 1.    3 1.  0 0 0 0
1  40 .0    0 .0    0 .0  0 0 0 0
1  24 .3   60 .0   42 .0  0 0 0 0
1   8 .0    3 1.   75 .0  0 0 0 1
1   4 .0   66 .0   58 .0  0 0 0 1
1  75 .0    8 .0    2 1.  0 0 0 0
0   1 1.    1 1.    1 1.  0 0 0 0
0   2 1.    3 1.    2 1.  0 0 0 0
0   3 1.    2 1.   60 .0  0 0 0 0
0   5 .8    4 1.    5 1.  0 0 0 0
0  12 .7   10 .8   14 .9  0 0 0 0
0   3 .0    2 1.    2 1.  0 0 0 0
0   4 .0    1 1.    3 1.  0 0 0 1
0   6 .0    3 .0    2 .0  0 0 0 0
0   5 .0   60 .0    0 .0  0 0 0 0
0   9 .0   70 .0    0 .0  0 0 0 0
0   7 .1   50 .0    3 1.  0 0 0 0
0   2 .0    4 .0    1 1.  0 0 0 0
0  20 .9   40 .0    6 1.  0 0 0 0
"""

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)([^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_OTHER = re.compile(r"<(?:!|\?|/)[^>]*>?")
_HINTS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z0-9]+")


@dataclass(frozen=True)
class Block:
    text: str
    words: int
    linked: int
    article: bool
    chrome_inside: bool
    chrome_around: bool
    heading: bool


def _place(name: str, attributes: str) -> str:
    """``article``, ``aside`` or ``chrome`` (not text), or nothing, by an element's name, role, class and id."""
    hints: set[str] = set()
    if attributes.strip():
        if _HIDDEN.search(attributes):
            return "chrome"
        for match in _HINTS.finditer(attributes):
            hints.update(_PARTS.split((match[1] or match[2] or match[3] or "").lower()))
    if name in ("html", "body"):
        return ""
    if name in ARTICLE:
        return "aside" if hints & COMMENT_HINTS else "article"
    if name in ASIDE or hints & ASIDE_HINTS:
        return "aside"
    if name in CHROME or hints & (CHROME_ROLES | CHROME_HINTS):
        return "chrome"
    return "article" if hints & ARTICLE_HINTS else ""


@dataclass(frozen=True)
class Nesting:
    """What the elements open at some point say about a block there: places so far, of which the last article is number ``article``
    (0: none), whether one of them stands aside and whether one before that article does."""

    places: int = 0
    article: int = 0
    aside: bool = False
    article_aside: bool = False

    def inside(self, place: str) -> Nesting:
        if not place:
            return self
        if place == "article":
            return Nesting(self.places + 1, self.places + 1, self.aside, self.aside)
        return Nesting(self.places + 1, self.article, self.aside or place == "aside", self.article_aside)


class OpenElements:
    """The elements open at some point, with the nesting after each; whether a name is open is known without looking through them."""

    def __init__(self):
        self.names: list[str] = []
        self.nestings = [Nesting()]
        self.counts: dict[str, int] = {}

    def push(self, name: str, place: str) -> None:
        self.names.append(name)
        self.nestings.append(self.nestings[-1].inside(place))
        self.counts[name] = self.counts.get(name, 0) + 1

    def pop(self) -> str:
        self.nestings.pop()
        name = self.names.pop()
        self.counts[name] -= 1
        return name

    def close(self, name: str) -> None:
        """Close the innermost element of that name with all inside it."""
        if self.counts.get(name):
            while self.pop() != name:
                pass


def blocks_of(html: str) -> list[Block]:
    """The flat text blocks of a page."""
    blocks: list[Block] = []
    open_elements = OpenElements()
    pieces: list[str] = []
    linked: list[str] = []
    links = skipping = 0
    heading = False
    pattern = _TAG
    at, n, last = 0, len(html), html.rfind(">")

    def close() -> None:
        words = "".join(pieces).split()
        if words:
            now = open_elements.nestings[-1]
            blocks.append(Block(
                " ".join(words), len(words), min(len(words), len(" ".join(linked).split())), now.article > 0, now.places > now.article,
                now.article_aside, heading))
        pieces.clear()
        linked.clear()

    def add(text: str) -> None:
        if text and not skipping:
            text = unescape(text)
            pieces.append(text)
            if links:
                linked.append(text)

    while at < n:
        less = html.find("<", at)
        if less < 0:
            add(html[at:])
            break
        add(html[at:less])
        if html.startswith("<!--", less):
            end = html.find("-->", less + 4)
            at = n if end < 0 else end + 3
            continue
        match = pattern.match(html, less) if less < last else None
        if match is None and less < last and pattern is _TAG and (match := _LOOSE.match(html, less)):
            pattern = _LOOSE  # a quote is open up to the end of the page
        if match is None:
            other = _OTHER.match(html, less)
            if other:
                at = other.end()
            else:
                add("<")
                at = less + 1
            continue
        at = match.end()
        closing, name, attributes = match[1], match[2].lower(), match[3]
        if name in SKIPPED:
            if name in RAW:
                if not closing:
                    end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
                    at = end.end() if end else n
            elif closing:
                skipping = max(0, skipping - 1)
            elif not attributes.rstrip().endswith("/") and name not in VOID:
                skipping += 1
            continue
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif name == "br":
                add(" ")
            elif not closing and attributes and not skipping and _place(name, attributes) in ("aside", "chrome"):
                close()
                open_elements.push(name, "chrome")
            if closing and open_elements.names and open_elements.names[-1] == name:
                close()
                open_elements.pop()
            continue
        close()
        if closing:
            open_elements.close(name)
            heading = False
        else:
            if name not in VOID and name not in ("p", "li", "tr", "td", "th", "dt", "dd") or _place(name, attributes):
                open_elements.push(name, _place(name, attributes))
            heading = len(name) == 2 and name[0] == "h" and name[1] in "123456"
            links = 0
        if name == "body":
            skipping = 0
    close()
    return blocks


def features(blocks: list[Block]) -> np.ndarray:
    """The ten features of each block of one page."""
    own = np.array([(b.words, b.linked / b.words) for b in blocks], dtype=float).reshape(-1, 2)
    none = np.zeros((1, 2))
    marks = np.array([(b.article, b.chrome_inside, b.chrome_around, b.heading) for b in blocks], dtype=float).reshape(-1, 4)
    return np.hstack([own, np.vstack([none, own[:-1]])[: len(own)], np.vstack([own[1:], none])[: len(own)], marks])


@dataclass(frozen=True)
class Tree:
    """A split (``feature`` at most ``limit`` goes low) or, without children, a leaf."""

    keep: bool
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def accepts(self, rows: np.ndarray) -> np.ndarray:
        if self.low is None or self.high is None:
            return np.full(len(rows), self.keep)
        low = rows[:, self.feature] <= self.limit
        out = np.empty(len(rows), dtype=bool)
        out[low], out[~low] = self.low.accepts(rows[low]), self.high.accepts(rows[~low])
        return out


def grow(rows: np.ndarray, keep: np.ndarray, depth: int = 8) -> Tree:
    """A tree that splits where the Gini impurity falls most; ties go to the earlier feature and the lower limit."""
    share = float(keep.mean())
    best = (0.0, -1, 0.0)
    if depth and 0 < share < 1:
        whole = len(keep) * share * (1 - share)
        for feature in range(rows.shape[1]):
            values = np.unique(rows[:, feature])
            for limit in (values[1:] + values[:-1]) / 2:
                low = rows[:, feature] <= limit
                parts = sum(len(k) * k.mean() * (1 - k.mean()) for k in (keep[low], keep[~low]))
                if whole - parts > best[0] + 1e-9:
                    best = (whole - parts, feature, float(limit))
    if best[1] < 0:
        return Tree(share >= 0.5)
    low = rows[:, best[1]] <= best[2]
    return Tree(share >= 0.5, best[1], best[2], grow(rows[low], keep[low], depth - 1), grow(rows[~low], keep[~low], depth - 1))


@cache
def trained_tree(table: str = LABELLED) -> Tree:
    numbers = np.array([line.split() for line in table.strip().splitlines()], dtype=float)
    return grow(numbers[:, 1:], numbers[:, 0] == 1)


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    found = [blocks_of(page) for page in pages]
    rows = np.vstack([features(b) for b in found]) if found else np.zeros((0, 10))
    keep = iter(tree.accepts(rows).tolist())
    return ["\n".join(b.text for b in blocks if next(keep)) for blocks in found]


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", labelled: str = LABELLED) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    tree = trained_tree(labelled)
    own = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(start, PAGES_AT_ONCE)
                texts = main_texts(part.column(2).to_pylist(), tree)
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in own.schema}
    return own.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
