"""Main text of web pages from the standard library's streaming parser.

Parser events become lines (blocks of text) with their counts of text characters and tags. The text-to-tag ratio of each
line is smoothed with a Gaussian, and lines whose smoothed ratio passes a threshold (a share of the standard deviation)
form the content clusters. They select the region: the innermost container (not a mere block of text) that holds
``HOLDS`` of the clusters' text. The region is the article, with its headings and short lines. Where no container below
the body holds the clusters, the region runs from their first line to their last, with a heading right above.

Elements that by tag, role or a plain class name hold no article text (menus, footers, sidebars, adverts, forms, comments)
have no ratio and no part in the result. Names that only hint at it (``related``, ``alert``, ``has-sidebar``) lower the
ratio of their lines, and the clusters decide: prose stays, short lines go. ``article`` and ``main`` tags choose nothing;
they only end an element above them that was never closed.

Defined results. Null or empty html, or a page without text: empty text, n_chars 0. A tag or comment that never ends takes
the rest of the page, as it does in browsers; other broken markup is read as far as the parser can. Pages are read whole, in
time linear in their length however deep they nest or how often something begins that never ends. Rows with equal or null keys are
read one by one. Empty table: no rows. Columns named like a result column are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Elements whose text is never article text.
SKIPPED = frozenset("nav footer aside form script style noscript template head title button select option textarea iframe svg math canvas object audio video dialog menu datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = frozenset(("html", "body"))
#: What a new block of text ends where it stands open.
ENDED = {"p": frozenset(("p",)), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")), "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p"))}
#: Class names, ids and roles of elements that hold no article text.
SURE = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsored sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies notice "
    "consent gdpr popup modal overlay newsletter share sharing comment comments commentlist replies disqus pagination pager complementary contentinfo".split()
)
#: Words in class names, ids and roles that only hint at it, as the sure ones do within longer names.
HINTS = SURE | frozenset("banner sponsor promo promotion header subscribe signup login search social related recommended reply respond discussion toolbar widget alert".split())
SPREAD, SHARE, HINTED, HOLDS = 2.0, 0.5, 0.25, 0.8


@dataclass
class Line:
    text: str
    tags: int
    links: int
    node: int
    heading: bool


class Reader(HTMLParser):
    """Collects lines and the tree of block elements: of each its parent, tag, and whether it is skipped or hinted at."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parent, self.tag, self.skipped, self.hinted = [-1], ["html"], [False], [False]
        self.open = [0]  # nodes
        self.names: Counter = Counter(html=1)  # of the open ones
        self.parts: list[str] = []
        self.tags = self.links = 0
        self.link = 0  # open elements when a link began, 0 outside one
        self.heading = False

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.tags:
            self.lines.append(Line(text, self.tags, self.links, self.open[-1], self.heading))
        self.parts, self.tags, self.links = [], 0, 0

    def shut(self, depth: int) -> None:
        for n in self.open[depth:]:
            self.names[self.tag[n]] -= 1
        del self.open[depth:]
        if self.link > len(self.open):
            self.link = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE:
            self.tags += 1
            self.link = len(self.open) if tag == "a" else self.link
            return
        self.flush()
        self.tags += 1
        if tag in VOID:
            self.parts.append(" ")
            return
        ended = ENDED.get(tag, ENDED["p"])
        while len(self.open) > 1 and self.tag[self.open[-1]] in ended:
            self.shut(len(self.open) - 1)
        above = self.open[-1]
        names = [w for k, v in attrs if k in ("class", "id", "role") for w in (v or "").lower().split()]
        sure = tag not in ROOTS and not SURE.isdisjoint(names)
        hint = tag == "header" or tag not in ROOTS and any(not HINTS.isdisjoint(re.split(r"[^a-z]+", w)) for w in names)
        skipped, hinted = self.skipped[above], self.hinted[above]
        if tag in ("article", "main") and not sure and not hint and not any(self.names[t] > 0 for t in SKIPPED):
            skipped = hinted = False  # what stood open above it was never closed
        self.parent.append(above)
        self.tag.append(tag)
        self.skipped.append(skipped or sure or tag in SKIPPED)
        self.hinted.append(hinted or hint)
        self.open.append(len(self.tag) - 1)
        self.names[tag] += 1
        self.heading = tag in HEADINGS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in INLINE:
            self.link = 0 if tag == "a" else self.link
            return
        self.flush()
        self.heading = False
        if self.names[tag] > 0 and tag not in ROOTS:
            depth = len(self.open) - 1
            while self.tag[self.open[depth]] != tag:
                depth -= 1
            self.shut(depth)

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.link:
            self.links += len(data.strip())


def smoothed(ratios: np.ndarray, spread: float = SPREAD) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights that fall outside are left out."""
    reach = int(3 * spread)
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / spread) ** 2)
    full = np.convolve(ratios, k)[reach : reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), k)[reach : reach + len(ratios)]


def content_lines(ratio: np.ndarray, share: float = SHARE) -> np.ndarray:
    """Which lines pass the threshold; a line of ratio 0 never does."""
    smooth = smoothed(ratio)
    return (ratio > 0) & (smooth > 0) & (smooth >= min(share * smooth.std(), ratio.max(initial=0.0)))


def region(reader: Reader, lines: list[Line], content: np.ndarray) -> int:
    """The innermost container that holds ``HOLDS`` of the text of the content lines; 0 if that is the page's root."""
    mass = np.zeros(len(reader.tag))
    holds_blocks = np.zeros(len(reader.tag), dtype=bool)
    for x, c in zip(lines, content):
        if x.text:
            mass[x.node] += len(x.text) * bool(c)
            holds_blocks[reader.parent[x.node]] = True
    for n in range(len(mass) - 1, 0, -1):  # a child always has a larger number than its parent
        mass[reader.parent[n]] += mass[n]
        holds_blocks[reader.parent[n]] |= holds_blocks[n]
    best, whole = 0, HOLDS * mass[0]
    for n in range(1, len(mass)):  # in the order of the page, so each is below the last one that was taken
        if mass[n] >= whole and holds_blocks[n]:
            best = n
    return 0 if reader.tag[best] in ROOTS else best


#: What the parser reads on from to its own end: comments, CDATA sections, and elements that hold plain text.
_SPAN = re.compile(r"<!--|<!\[CDATA\[|<(script|style|textarea|title)\b", re.I)
_TAG = re.compile(r"<[a-zA-Z/!?]")


def ended(html: str) -> str:
    """The page up to the first tag, comment or section that never ends. The parser would take each of them for text only
    after a search to the end of the page; here such a search fails once."""
    at = 0
    while found := _SPAN.search(html, at):
        if found[1]:
            end = re.compile(f"</{found[1]}", re.I).search(html, found.end())
            if not end:
                return html  # all of the rest is its text
        elif not (end := re.compile("--!?>" if found[0] == "<!--" else r"\]\]>").search(html, found.start() + 2)):
            html = html[: found.start()]
            break
        at = end.end()
    last = html.rfind(">") + 1
    open_ = _TAG.search(html, last)
    return html[: open_.start()] if open_ else html


def main_text(html: str | None) -> str:
    reader = Reader()
    reader.feed(ended(html or ""))
    reader.close()
    reader.flush()
    lines = [x for x in reader.lines if x.text or x.tags]
    if not lines:
        return ""
    kept = np.array([bool(x.text) and not reader.skipped[x.node] for x in lines])
    usable = kept & np.array([2 * x.links <= max(1, len(x.text)) for x in lines])
    hinted = np.array([reader.hinted[x.node] for x in lines])
    content = content_lines(np.array([len(x.text) / max(1, x.tags) for x in lines]) * usable * np.where(hinted, HINTED, 1.0))
    if not content.any():
        return ""
    if top := region(reader, lines, content):
        inside = np.zeros(len(reader.tag), dtype=bool)
        inside[top] = True
        for n in range(top + 1, len(inside)):
            inside[n] = inside[reader.parent[n]]
        # a hint on the region itself says nothing of its lines
        doubtful = hinted & ~content if not reader.hinted[top] else np.zeros(len(lines), dtype=bool)
        take = kept & ~doubtful & inside[[x.node for x in lines]]
        take |= kept & np.array([reader.tag[x.node] in HEADINGS and reader.tag[reader.parent[x.node]] == "header" for x in lines]) & inside[[x.node for x in lines]]
        above = int(np.flatnonzero(inside[[x.node for x in lines]])[0])
        while above > 0 and (lines[above - 1].heading or not lines[above - 1].text):  # a heading beside the region, right above it
            above -= 1
            take[above] = kept[above] and not hinted[above] and reader.parent[lines[above].node] == reader.parent[top]
    else:
        near = np.flatnonzero(content)
        first, last = int(near[0]), int(near[-1])
        take = usable & ~(hinted & ~content)
        take[last + 1 :] = False
        above = first
        while above > 0 and (lines[above - 1].heading or not lines[above - 1].text):
            above -= 1
        take[:above] = False
    return " ".join(x.text for x, t in zip(lines, take) if t)


def html_extraction(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages (without the html) with text and n_chars."""
    small_batches(pages)

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series([main_text(h) for h in x], dtype=object)

    rest = [F.col(f"`{c}`") for c in pages.columns if c not in (html, "text", "n_chars")]
    out = pages.select(*rest, extracted(F.coalesce(F.col(html), F.lit(""))).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
