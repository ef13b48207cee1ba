"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once from front to back into text blocks: stretches of text that no block-level tag breaks. Of each
block a few numbers are known: words, link density, the same of the blocks before and after it, and in which kind of
part it stands. A decision tree, grown from the small labelled table below, tells content from boilerplate.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is never text of the page (fixed values): those that browsers read as plain characters up to
#: their own end tag or the end of the page, and those with elements inside.
RAW = ("script", "style", "noscript", "iframe", "textarea", "title")
NESTED = ("template", "svg", "object", "canvas", "audio", "video", "select", "button", "annotation", "annotation-xml")
#: Elements that may stand in a page's head; any other ends it.
HEAD = frozenset("base basefont bgsound link meta noframes template script style noscript title".split())
#: Elements of which none stands in another of its kind: a second one ends the first.
SINGLE = frozenset(("select", "button"))
#: Elements that may stand in an unseen one without an end tag; any other that breaks a line ends it.
WITHIN = frozenset(("option", "optgroup", "source", "track", "param", "img"))
#: Elements of a page that end a drawing or formula without an end tag.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup "
    "table tt u ul var html article aside footer form header main nav section td th tr tbody".split()
)
#: Elements that stay within a line of text (fixed values).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
#: Elements that have no content (fixed values).
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Parts of a page that are not its text, by element and by words in class, id and role (fixed values).
ASIDE_TAGS = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "fieldset"))
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent notice notices alert popup modal overlay comment comments disqus "
    "respond reply replies sidebar nav navbar navigation menu breadcrumb breadcrumbs footer header masthead share sharing social related recommended widget subscribe "
    "newsletter signup login search pagination pager toc skip contentinfo complementary".split()
)
#: Words that set a part aside alone or before one of the second list only, words of which inside a main part none is set aside, and words
#: that begin the name of a layout, which says nothing of the part itself (fixed values).
SOFT_WORDS = frozenset(("related", "recommended"))
LISTED_WORDS = frozenset("article articles content items links list post posts products reading stories story topics".split())
HEAD_WORDS = frozenset(("header", "masthead"))
LAYOUT_WORDS = frozenset(("has", "no", "with", "without"))
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article post entry story main content".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

OUTSIDE, ASIDE, MAIN = 0, 1, 2
FEATURES = ("part", "page_has_main", "words", "link_density", "words_before", "links_before", "words_after", "links_after")
#: Labelled blocks (1: content), in the order of FEATURES: made by hand from common page layouts.
LABELLED = (
    # Pages with a part marked as the main one: its blocks are content, however short, unless they are links only.
    (2, 1, 9, 0.0, 1, 1.0, 60, 0.0, 1),
    (2, 1, 60, 0.0, 9, 0.0, 45, 0.0, 1),
    (2, 1, 45, 0.02, 60, 0.0, 2, 0.0, 1),
    (2, 1, 1, 0.0, 45, 0.0, 80, 0.05, 1),
    (2, 1, 2, 0.0, 1, 0.0, 1, 0.0, 1),
    (2, 1, 120, 0.1, 2, 0.0, 12, 0.0, 1),
    (2, 1, 12, 0.0, 120, 0.1, 6, 0.6, 1),
    (2, 1, 30, 0.4, 50, 0.0, 50, 0.0, 1),
    (2, 1, 3, 1.0, 2, 0.0, 40, 0.0, 1),
    (2, 1, 1, 1.0, 40, 0.0, 20, 0.0, 1),
    (2, 1, 14, 1.0, 20, 0.0, 30, 0.0, 1),
    (0, 1, 2, 1.0, 0, 0.0, 1, 1.0, 0),
    (0, 1, 5, 0.0, 1, 1.0, 9, 0.0, 0),
    (0, 1, 25, 0.0, 40, 0.0, 3, 0.5, 0),
    (0, 1, 70, 0.0, 3, 0.0, 10, 0.0, 0),
    (0, 1, 10, 0.3, 60, 0.0, 0, 0.0, 0),
    # Parts set aside are boilerplate with and without a main part, long ones too.
    (1, 1, 1, 1.0, 0, 0.0, 1, 1.0, 0),
    (1, 1, 8, 0.0, 1, 1.0, 9, 0.0, 0),
    (1, 1, 55, 0.0, 90, 0.0, 20, 0.0, 0),
    (1, 1, 20, 0.2, 55, 0.0, 0, 0.0, 0),
    (1, 0, 2, 1.0, 0, 0.0, 2, 1.0, 0),
    (1, 0, 40, 0.0, 60, 0.0, 6, 0.5, 0),
    (1, 0, 90, 0.0, 12, 0.0, 30, 0.0, 0),
    (1, 0, 6, 0.0, 2, 1.0, 50, 0.0, 0),
    # Pages without marks: long blocks with few links are content, and short ones between such.
    (0, 0, 60, 0.0, 8, 0.0, 45, 0.0, 1),
    (0, 0, 45, 0.05, 60, 0.0, 30, 0.0, 1),
    (0, 0, 30, 0.1, 45, 0.0, 4, 1.0, 1),
    (0, 0, 25, 0.0, 3, 1.0, 70, 0.0, 1),
    (0, 0, 16, 0.0, 25, 0.0, 22, 0.0, 1),
    (0, 0, 8, 0.0, 3, 1.0, 60, 0.0, 1),
    (0, 0, 6, 0.0, 40, 0.0, 50, 0.0, 1),
    (0, 0, 4, 0.0, 30, 0.1, 35, 0.0, 1),
    (0, 0, 2, 0.0, 50, 0.0, 40, 0.0, 1),
    (0, 0, 1, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 12, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 3, 1.0, 0, 0.0, 2, 1.0, 0),
    (0, 0, 2, 1.0, 3, 1.0, 60, 0.0, 0),
    (0, 0, 20, 0.9, 3, 1.0, 25, 0.8, 0),
    (0, 0, 40, 0.7, 60, 0.0, 30, 0.9, 0),
    (0, 0, 5, 0.0, 2, 1.0, 3, 1.0, 0),
    (0, 0, 4, 0.0, 3, 1.0, 6, 0.5, 0),
    (0, 0, 7, 0.2, 6, 0.6, 2, 1.0, 0),
    (0, 0, 9, 0.4, 30, 0.0, 2, 1.0, 0),
    (0, 0, 3, 0.5, 5, 1.0, 4, 0.8, 0),
)

_BEGIN = re.compile(r"<(?:(?P<other>!--|!\[CDATA\[|[!?])|(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]{0,63}))")
_REST = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_STOP = re.compile("[>\"']")
_RAW_ENDS = {tag: re.compile(f"</{tag}\\s*>", re.I) for tag in RAW}
#: Characters of a tag looked at before its end is sought in steps.
_SHORT = 256
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


class Token(NamedTuple):
    """A tag (``tag`` in small letters, what follows it in ``rest``), plain characters of the page (``cdata``), an element that browsers
    read as plain characters (``raw``), or something without text."""

    start: int
    end: int
    tag: str = ""
    close: bool = False
    rest: str = ""
    raw: bool = False
    cdata: str | None = None


class _TagEnds:
    """Where tags end: at the first ``>`` outside quotes. What was once looked through in vain is not looked through again."""

    def __init__(self, page: str):
        self._page = page
        self._last = {c: page.rfind(c) for c in ">\"'"}
        self._vain: set[int] = set()
        self._from, self._stop = 0, -1

    def after(self, at: int) -> int:
        """End of the tag whose name ends at ``at``, or -1 if it has none."""
        page = self._page
        if self._last[">"] < at:
            return -1
        short = _REST.match(page, at, min(len(page), at + _SHORT))
        if short:
            return short.end()
        trail = []
        while at not in self._vain:
            trail.append(at)
            if not self._from <= at <= self._stop:
                found = _STOP.search(page, at)
                self._from, self._stop = at, found.start() if found else len(page)
            stop = self._stop
            if stop == len(page):
                break
            if page[stop] == ">":
                return stop + 1
            if self._last[page[stop]] == stop:
                break
            at = page.find(page[stop], stop + 1) + 1
        self._vain.update(trail)
        return -1


def tokens(page: str) -> list[Token]:
    """Tags, comments and the like, in page order, in time that grows with the page's length however broken it is.

    A ``<`` that begins nothing, or a tag without an end, is text.
    """
    out: list[Token] = []
    ends, last_cdata, at = _TagEnds(page), page.rfind("]]>"), 0
    last = page.rfind(">")
    while found := _BEGIN.search(page, at):
        start, at = found.start(), found.end()
        other = found["other"]
        if other == "!--":
            end = page.find("-->", at)
            at = end + 3 if end >= 0 else len(page)
            out.append(Token(start, at))
        elif other == "![CDATA[" and last_cdata >= at:
            end = page.find("]]>", at)
            out.append(Token(start, end + 3, cdata=page[at:end]))
            at = end + 3
        elif other:
            end = page.find(">", start) if last > start else -1
            if end >= 0:
                at = end + 1
                out.append(Token(start, at))
        else:
            end = ends.after(at)
            if end < 0:
                at = start + 1
                continue
            tag, rest, close = found["tag"].lower(), page[at : end - 1], bool(found["close"])
            at = end
            raw = tag in _RAW_ENDS and not close
            if raw:
                over = _RAW_ENDS[tag].search(page, end)
                at = over.end() if over else len(page)
            out.append(Token(start, at, tag, close, rest, raw))
    return out


def _ends(found: list[Token]) -> dict[int, int]:
    """Where unseen elements with elements inside end, by where they start; those without an end tag of their own are
    left out."""
    out: dict[int, int] = {}
    begun: dict[str, list[int]] = {tag: [] for tag in NESTED}
    for token in found:
        if token.tag not in begun:
            continue
        starts = begun[token.tag]
        if token.close:
            if starts:
                out[starts.pop()] = token.end
        elif not _closes_itself(token.tag, token.rest):
            if token.tag in SINGLE:
                starts.clear()
            starts.append(token.start)
    return out


class _Parts:
    """Parts that are open, outermost first, and how many of each tag and kind there are."""

    def __init__(self) -> None:
        self.open: list[tuple[str, int]] = []
        self.tags: Counter[str] = Counter()
        self.kinds: Counter[int] = Counter()

    def begin(self, tag: str, kind: int) -> None:
        self.open.append((tag, kind))
        self.tags[tag] += 1
        self.kinds[kind] += 1

    def end(self) -> str:
        tag, kind = self.open.pop()
        self.tags[tag] -= 1
        self.kinds[kind] -= 1
        return tag

    def close(self, tag: str) -> None:
        """Ends the innermost part of a tag and all in it."""
        while self.tags[tag] and self.end() != tag:
            pass

    def kind(self) -> int:
        """The innermost mark decides, but nothing inside a part set aside is main, save the headings of a main part."""
        return ASIDE if self.kinds[ASIDE] else MAIN if self.kinds[MAIN] else OUTSIDE


def _closes_itself(tag: str, rest: str) -> bool:
    return tag == "svg" and rest.rstrip().endswith("/")


def _ends_unclosed(unclosed: str, tag: str) -> bool:
    """Whether a tag ends an unseen element that has no end tag."""
    if unclosed == "template":
        return False
    if unclosed == "svg":
        return tag in BREAKOUT
    return tag not in INLINE and tag not in WITHIN


def blocks_of(page: str) -> list[tuple[str, int, int, int]]:
    """Text, words, words in links and kind of part of each block, in page order."""
    out: list[tuple[str, int, int, int]] = []
    parts = _Parts()
    text: list[str] = []
    linked: list[str] = []
    in_link, at = 0, 0
    # Up to where all is unseen, the unseen element without an end tag, and whether this is the page's head.
    unseen_to, unclosed, in_head = 0, "", False
    found = tokens(page)
    ends = _ends(found)
    part = OUTSIDE

    def flush() -> None:
        nonlocal text, linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                out.append((whole, whole.count(" ") + 1, len("".join(linked).split()), part))
            text, linked = [], []

    def put(piece: str) -> None:
        if piece:
            text.append(piece)
            if in_link:
                linked.append(f"{piece} ")

    for token in found:
        before, at = page[at : token.start], token.end
        if token.start < unseen_to:
            continue
        if in_head and before.strip():
            in_head = False
        if not in_head and not unclosed:
            put(html.unescape(before))
        if token.cdata is not None:
            if not in_head and not unclosed:
                put(token.cdata)
            continue
        tag, rest = token.tag, token.rest
        if token.raw:
            in_head = in_head and tag in HEAD
            if tag in ("textarea", "title"):
                flush()
            continue
        if not tag:
            continue
        if unclosed:
            if not _ends_unclosed(unclosed, tag):
                continue
            unclosed = ""
        if tag == "head":
            flush()
            in_head = not token.close
            continue
        if in_head:
            if tag in HEAD and tag != "template" or token.close and tag not in ("body", "html", "br"):
                continue
            in_head = tag == "template"
        if tag in NESTED:
            if tag == "select":
                flush()
            if not token.close and not _closes_itself(tag, rest):
                unseen_to = ends.get(token.start, 0)
                unclosed = "" if unseen_to else tag
            continue
        if tag == "a":
            in_link = 0 if token.close else 1
        if tag == "br":
            put(" ")
        if tag in INLINE and not (rest and _aside(rest, parts)) and not (token.close and parts.tags[tag]):
            continue
        flush()
        if token.close:
            parts.close(tag)
        elif tag not in EMPTY and not rest.rstrip().endswith("/"):
            if parts.open and parts.open[-1][0] in ("p", "li") and (tag == parts.open[-1][0] or parts.open[-1][0] == "p"):
                parts.end()  # their end tags may be left out
            kind = _kind(tag, rest, parts)
            if kind is not None:
                parts.begin(tag, kind)
        part = parts.kind()
    if not unclosed:
        put(html.unescape(page[at:]))
    flush()
    return out


def _said(name: str, inside: bool) -> int:
    """What one name of a class, id or role says of its part: aside, main or neither."""
    words = [w for w in _SPLIT.split(name) if w]
    if not words or words[0] in LAYOUT_WORDS:
        return OUTSIDE
    for i, word in enumerate(words):
        if word in HEAD_WORDS and inside:
            continue
        if word in ASIDE_WORDS and (word not in SOFT_WORDS or all(w in LISTED_WORDS or w in ASIDE_WORDS for w in words[i + 1 :])):
            return ASIDE
    return MAIN if not MAIN_WORDS.isdisjoint(words) and HEAD_WORDS.isdisjoint(words) else OUTSIDE


def _marked(rest: str, parts: _Parts) -> int:
    """What a tag's class, id and role say together: a name of main words only outweighs others of the same attribute."""
    out = OUTSIDE
    for value in _NAMED.findall(rest):
        said = {_said(name, bool(parts.kinds[MAIN])) for name in value.strip("\"'").lower().split()}
        if ASIDE in said and MAIN not in said:
            return ASIDE
        out = MAIN if MAIN in said else out
    return out


def _aside(rest: str, parts: _Parts) -> bool:
    return bool(_HIDDEN.search(rest)) or _marked(rest, parts) == ASIDE


def _kind(tag: str, rest: str, parts: _Parts) -> int | None:
    """Which kind of part a tag opens: none for paragraphs and the like, which end without a word."""
    if tag in ASIDE_TAGS:
        return ASIDE
    if tag == "header":
        # The head of an article is part of it; that of a page is not.
        return OUTSIDE if parts.kinds[MAIN] else ASIDE
    if tag in MAIN_TAGS:
        # Articles inside what is set aside, such as comments, stay aside.
        return ASIDE if rest and _aside(rest, parts) else MAIN
    if tag in ("body", "html"):
        return None
    if rest and _aside(rest, parts):
        return ASIDE
    if tag in ("div", "section", "td"):
        return MAIN if rest and _marked(rest, parts) == MAIN else OUTSIDE
    return None


@dataclass
class Node:
    """A test ``feature <= bound`` with what follows if it holds and if not, or a verdict."""

    feature: int = -1
    bound: float = 0.0
    below: Node | None = None
    above: Node | None = None
    content: bool = False


def grow(rows: np.ndarray, labels: np.ndarray, smallest: int = 1) -> Node:
    """A decision tree by Gini impurity; of equally good tests the first by feature and bound."""
    content = bool(2 * labels.sum() >= len(labels))
    if labels.min() == labels.max() or len(labels) <= smallest:
        return Node(content=content)
    best: tuple[float, int, float] | None = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for bound in ((values[1:] + values[:-1]) / 2).tolist():
            below = rows[:, feature] <= bound
            cost = sum(n.sum() * (p := labels[n].mean()) * (1 - p) for n in (below, ~below))
            if best is None or cost < best[0] - 1e-12:
                best = (float(cost), feature, bound)
    if best is None:
        return Node(content=content)
    below = rows[:, best[1]] <= best[2]
    return Node(best[1], best[2], grow(rows[below], labels[below], smallest), grow(rows[~below], labels[~below], smallest), content)


def verdicts(tree: Node, rows: np.ndarray) -> np.ndarray:
    """Whether each row is content."""
    if tree.feature < 0:
        return np.full(len(rows), tree.content)
    below = rows[:, tree.feature] <= tree.bound
    out = np.empty(len(rows), bool)
    out[below] = verdicts(tree.below, rows[below])
    out[~below] = verdicts(tree.above, rows[~below])
    return out


def trained(labelled: Sequence[tuple] = LABELLED) -> Node:
    table = np.array(labelled, float)
    return grow(table[:, :-1], table[:, -1])


def _features(found: list[tuple[str, int, int, int]]) -> np.ndarray:
    words = np.array([b[1] for b in found], float)
    density = np.array([b[2] for b in found], float) / words
    part = np.array([b[3] for b in found], float)
    has_main = np.full(len(found), float((part == MAIN).any()))
    before, after = (lambda x: np.r_[0.0, x[:-1]]), (lambda x: np.r_[x[1:], 0.0])
    return np.stack([part, has_main, words, density, before(words), before(density), after(words), after(density)], axis=1)


def main_text(page: str, tree: Node) -> str:
    """The content blocks of a page, two newlines between them."""
    found = blocks_of(page)
    if not found:
        return ""
    return "\n\n".join(b[0] for b, keep in zip(found, verdicts(tree, _features(found)), strict=True) if keep)


def _extract(batches: Iterator[pa.RecordBatch], tree: Node) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page, tree) if page else "" for page in batch.column("html").to_pylist()]
        arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, labelled: Sequence[tuple] = LABELLED) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every row: the article of the page.

    Character references are decoded, white space inside a block becomes one blank, blocks are trimmed and joined in
    page order by two newlines. Line breaks (``br``) are white space. Menus, headers, footers, sidebars, notices,
    adverts, forms, comments of readers, hidden parts, scripts and styles are left out. ``labelled`` is the table the
    tree is grown from: the numbers named in ``FEATURES`` and 1 for content.

    A null, empty or text-free page gives an empty text; comments, quotes, scripts and the like without an end run
    to the end. A head ends where something begins that may not stand in it; drawings, buttons, objects and the like
    without an end tag end at the next tag that breaks the line. Pages are read whole. Each row is worked on by itself, so repeated and null ids give
    a row each. An empty table gives no rows. Other columns are ignored.
    """
    tree = trained(labelled)
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(
        lambda b: _extract(b, tree), f"page_id {kind}, url string, text string, n_chars long"
    )
