"""Main text of web pages by line-block distribution: text lengths are summed over sliding windows of lines, and what lies between
a surge and the next dive is kept."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellquant.llm.common import with_fields

#: lines of a window; a gap of fewer lines without text does not end the main text
WINDOW = 3
#: a surge holds this share of the fullest window's text, but need not hold more than SURGE characters
SHARE, SURGE = 0.3, 80
#: pages of a batch that goes back at a time
ROWS = 256

#: markup: comments, declarations, and tags whose attributes may quote a bracket
_TAG = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?>[^>=]+|=\s*"[^"]*"|=\s*'[^']*'|=)*)(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: elements within a line; all others begin and end lines
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
#: elements that are never main text
_ASIDE = set("nav aside footer form menu dialog head script style title noscript template svg math canvas object embed applet audio video map iframe noembed noframes button select option textarea datalist input label fieldset".split())
_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
#: words in class and id that mark what is not main text
_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer "
    "bottombar sidebar aside widget widgets related recommended recommendations trending popular share sharing social newsletter subscribe subscription signup login register cookie cookies consent "
    "gdpr notice notices notification notifications alert alerts popup modal overlay lightbox toast comment comments commentlist disqus respond replies form searchform searchbox pagination pager "
    "copyright disclaimer imprint toolbar hidden tagcloud paywall".split()
)
#: the same written as one word (cookiebar, commentsection, mainmenu, sitefooter)
_JOINED = re.compile(r"(?:cookie|sidebar|advert|newsletter|breadcrumb|sponsor|navbar|adsby)[a-z]+|comments?(?:list|form|section|area|box|block|wrapper|thread|container)|(?:site|main|page|top|global)(?:nav|menu|footer|header|bar)|ad(?:box|banner|slot|unit|container|wrapper|block|space)")
#: beside such a word in one name, the others describe something else (has-sidebar, post-header)
_BESIDE = {"has", "no", "with", "without", "not", "open", "enabled", "closed"}
_ARTICLE = {"article", "post", "entry", "content", "story"}
#: a heading of these words alone, with or without a number, begins the readers' comments
_COMMENTS = re.compile(r"[\W\d]*(?:reader|user|leser|leave an?|post an?|add an?)?[\W\d]*(?:comments?|reply|kommentare?|commentaires?|comentarios?)[\W\d]*", re.I)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: blocks that end a line; containers make an empty line as well
_LINES = _HEADINGS | {"p", "li", "dt", "dd", "tr", "td", "th", "pre", "figcaption", "caption", "summary", "address", "hr"}
_IN_HEAD = {"title", "meta", "link", "script", "style", "base", "noscript", "template"}
_MARKS = ("article", "main", "articlebody")


def _pieces(html: str) -> Iterator[tuple[str | None, str, str]]:
    """(None, "", text), (name, "", attributes) of a start tag and (name, "/", "") of an end tag, in order."""
    at, n = 0, len(html)
    while at < n:
        tag = _TAG.search(html, at)
        if tag is None:
            yield None, "", html[at:]
            return
        if tag.start() > at:
            yield None, "", html[at : tag.start()]
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        yield name, tag[1], tag[3]
        if not tag[1] and name in _RAW:  # up to the end tag nothing is markup
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else n


def _said(name: str, attributes: str) -> tuple[bool, set[str], set[str]]:
    """What a start tag says: surely no main text; words of its names that say so; marks of an article."""
    names: set[str] = set()
    aside, marks = name in _ASIDE, {name} & set(_MARKS)
    for key, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), unescape(value.strip("\"'")).strip()
        if key in ("class", "id"):
            for part in value.split():
                words = {w.lower() for w in _TOKEN.findall(part)}
                if not words & _BESIDE:
                    names |= words & _NAMES - ({"header"} if words & _ARTICLE else set())
                    names |= {w for w in words if _JOINED.fullmatch(w)}
        elif key == "role":
            aside |= value.lower() in _ROLES
            marks |= {value.lower()} & {"article", "main"}
        elif key == "itemprop":
            marks |= {value.lower()} & {"articlebody"}
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            aside = True
        elif key == "style":
            aside |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
    return aside, names, marks


class _Page:
    """Elements of a page by number (parents first), and its events: (element, text) or (element, None) at the edge of a block."""

    def __init__(self, html: str) -> None:
        self.name, self.parent, self.aside, self.names, self.marks = ["html"], [0], [False], [set()], [set()]
        self.events: list[tuple[int, str | None]] = []
        stack = [0]
        self.open: Counter[str] = Counter()
        for name, end, rest in _pieces(html):
            if name is None:
                self.events.append((stack[-1], rest))
            elif end:
                self._end(stack, name)
            else:
                self._start(stack, name, rest)

    def _end(self, stack: list[int], name: str) -> None:
        at = len(stack) - 1 if self.open[name] else 0
        while at > 0 and self.name[stack[at]] != name and (name not in _INLINE or self.name[stack[at]] in _INLINE):
            at -= 1
        if at > 0 and self.name[stack[at]] == name:
            edges = [(x, None) for x in reversed(stack[at:]) if self.name[x] not in _INLINE]
            self.events += edges
            self.open.subtract(self.name[x] for x in stack[at:])
            del stack[at:]
        elif name not in _INLINE:
            self.events.append((stack[-1], None))

    def _start(self, stack: list[int], name: str, rest: str) -> None:
        if name == "br":
            self.events.append((stack[-1], " "))
            return
        if name in ("html", "body") or name in _VOID and name in _INLINE:
            if name == "body" and self.open["head"] > 0:
                self.open.clear()
                del stack[1:]
            return
        if name not in _IN_HEAD and self.name[stack[-1]] == "head":
            self._pop(stack)  # its end tag may be left out, as those of paragraphs, items and inline elements
        if name not in _INLINE:
            while self.name[stack[-1]] in _INLINE and self.name[stack[-1]] != "a":
                self._pop(stack)
            if self.name[stack[-1]] == "p" or self.name[stack[-1]] == name and name in _LINES:
                self.events.append((self._pop(stack), None))
        elif name == "a" and "a" in (self.name[x] for x in stack[-3:]):
            self._end(stack, "a")
        aside, names, marks = _said(name, rest)
        if name == "header" and not any(self.marks[x] for x in stack):
            names = names | {"header"}
        x = len(self.name)
        for kept, value in ((self.name, name), (self.parent, stack[-1]), (self.aside, aside), (self.names, names), (self.marks, marks)):
            kept.append(value)
        if name not in _INLINE:
            self.events.append((x, None))
        if name not in _VOID and not (rest.endswith("/") and name in ("svg", "math")):
            self.open[name] += 1
            stack.append(x)

    def _pop(self, stack: list[int]) -> int:
        x = stack.pop()
        self.open[self.name[x]] -= 1
        return x

    def off(self) -> list[bool]:
        """Elements whose text is no main text. Names do not count for what holds an article, nor an article's own names unless
        they say that it is a comment."""
        n = len(self.name)
        comment = {"comment", "comments", "commentlist", "related"}
        holds, out = [False] * n, [False] * n
        for x in range(n - 1, 0, -1):
            if self.marks[x] and not self.names[x] & comment and not self.aside[x]:
                holds[x] = True
            if holds[x] and not self.names[x] & comment:
                holds[self.parent[x]] = True
        for x in range(1, n):
            out[x] = out[self.parent[x]] or self.aside[x] or bool(self.names[x]) and not holds[x]
        return out

    def article(self, off: list[bool]) -> list[bool] | None:
        """Elements inside what is marked up as the article, if that holds a quarter of the text that may be main text."""
        sizes = [0] * len(self.name)
        for x, text in self.events:
            if text and not off[x]:
                sizes[x] += len(text.strip())
        for mark in _MARKS:
            inside = [mark in m for m in self.marks]
            for x in range(1, len(inside)):
                inside[x] |= inside[self.parent[x]]
            if 4 * (found := sum(n for n, i in zip(sizes, inside, strict=True) if i)) >= sum(sizes) and found:
                return inside
        return None

    def lines(self) -> tuple[list[str], list[int], bool]:
        """Lines of text; of each the characters outside links (0: none, or no main text); whether an article is marked up.

        A line is a block's text with white space turned into single spaces. What is no main text is an empty line, once for
        all neighbours, and each edge of a container is one as well. So are ``WINDOW`` lines of links alone, or more, that
        follow each other."""
        off = self.off()
        inside = self.article(off)
        if inside:
            off = [o or not i for o, i in zip(off, inside, strict=True)]
        linked, headed = [n == "a" for n in self.name], [n in _HEADINGS for n in self.name]
        for x in range(1, len(linked)):
            headed[x] |= headed[self.parent[x]]
            linked[x] = (linked[x] or linked[self.parent[x]]) and not headed[x]  # a title may be a link
        texts: list[str] = []
        sizes: list[int] = []
        held: list[str] = []
        free, muted, gone = 0, -1, False

        def within(x: int, of: int) -> bool:
            while x > of:
                x = self.parent[x]
            return x == of

        for x, text in [*self.events, (0, None)]:
            if muted >= 0 and not within(x, muted):
                muted = -1
            if text is not None:
                if off[x] or muted >= 0:
                    gone = gone or bool(text.strip())
                else:
                    held.append(text)
                    free += 0 if linked[x] else len("".join(text.split()))
                continue
            line = " ".join(unescape("".join(held)).split())
            if line and self.name[x] in _HEADINGS and _COMMENTS.fullmatch(line) and len(line) < 40:
                muted, line = self.parent[x], ""
            if line:
                texts.append(line)
                sizes.append(free)
            elif self.name[x] not in _LINES and not off[x] or gone and sizes and sizes[-1]:
                texts.append("")
                sizes.append(0)
            held, free, gone = [], 0, False
        links: list[int] = []
        for i, size in enumerate([*sizes, 1]):
            if size:
                for k in links if len(links) >= WINDOW else ():  # a menu, whole
                    texts[k] = ""
                links = []
            elif texts[i]:
                links.append(i)
        return texts, sizes, inside is not None


def distribution(sizes: list[int], window: int = WINDOW) -> np.ndarray:
    """Characters in each window of lines, by its first line."""
    total = np.concatenate(([0], np.cumsum(sizes), np.full(window, sum(sizes))))
    return total[window : window + len(sizes)] - total[: len(sizes)]


def surges(sizes: list[int], least: float) -> list[tuple[int, int]]:
    """Spans of lines from a rise out of empty windows to the dive back, of those in which some window reaches ``least``."""
    sums = distribution(sizes)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (sums > 0).view(np.int8), [0]))))
    return [(a, z) for a, z in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if sums[a:z].max() >= least]


def page_text(html: str | None) -> str:
    """The main text of a page: lines of its surges, joined by one line feed; empty if there is none. Lines of links alone at the
    ends of a surge stay only inside a marked article."""
    texts, sizes, marked = _Page(html or "").lines()
    if not any(sizes):
        return ""
    kept: list[str] = []
    upto = 0
    for a, z in surges(sizes, 1 if marked else min(SURGE, SHARE * distribution(sizes).max())):
        if marked:
            a, z = max(a, upto), min(z + WINDOW - 1, len(texts))
        else:
            a = next(i for i in range(a, z) if sizes[i])
        kept += texts[a:z]
        upto = z
    return "\n".join(filter(None, kept))


def main_text(pages: DataFrame) -> DataFrame:
    """Every row with text, the main text of its html, without markup, menus, headers, footers, sidebars, notices, adverts,
    forms, scripts and readers' comments; character references are decoded.

    A null or empty html, and a page without main text, have the empty text. The whole page is read whatever its length.
    Rows are judged each by itself, so repeated ones stay; an empty table gives an empty result. A column named text is
    replaced, others stay.
    """
    kept = [c for c in pages.columns if c.lower() != "text"]
    place = kept.index("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                found = pa.array([page_text(h.as_py()) for h in part.column(place)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*kept, "text"])

    rows = pages.select(*(pages[c] for c in kept))
    return rows.mapInArrow(run, with_fields(rows, "text string"))
