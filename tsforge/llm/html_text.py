"""Main text of web pages from streamed parser events and text-to-tag ratios.

The standard library's parser sends a page's tags and text as events; block-level tags cut
them into lines. Each line has a text-to-tag ratio, smoothed over its neighbours with a
Gaussian, and lines above the page's own threshold (the deviation of the smoothed ratios) are
content. Link text adds tags and no text to a ratio. Content text votes for the element that holds
it: an article or main element when there is one (each of several articles with half the text of
the longest), else the innermost element with most of the content. Its lines are the main text, but
for lines inside menus, adverts, notices, comments and the like, and lines of links: those go, except
headings and paragraphs whose smoothed ratio is above the threshold.

A form, and an element whose class or id only names such a part, is left out on probation: it counts
as content when most of the page's content, found before these names are looked at, lies in it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import beside, texts_of

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style noscript template iframe object svg math canvas audio video head title select textarea button option datalist".split())
BOILERPLATE = frozenset("nav footer aside menu dialog".split())
ENDED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 dt dd li".split())
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "outbrain pager pagination paywall popup promo promotion recommended related replies reply respond share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription taboola toolbar widget".split()
)
#: What may follow a marked word in a name that starts with it.
LAYOUT = frozenset(
    "area bar block body bottom box btn button buttons center container content form group head icon icons inner item items label left link "
    "links list main message outer panel post posts primary right secondary section slot text thread title top unit wrap wrapper".split()
)
#: First words of names that state something about an element and do not say what it is.
STATES = frozenset("has have is no not with without hide show enable enabled disable disabled".split())
#: First words of headers that belong to the text.
TEXT_HEADERS = frozenset("article content entry page post section single story title".split())
#: What readers write is no content beside an article, even if there is more of it.
TALK = frozenset("comment comments commentlist disqus replies reply respond".split())
REGIONS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARTS = re.compile(r"[a-z]+")


def marked(names: str) -> bool:
    """Whether one of the class names or ids says that its element is no content.

    A name counts by its last word, or by its first when only layout words follow.
    """
    for name in names.split():
        parts = _PARTS.findall(name)
        if not parts or parts[0] in STATES or parts[-1] == "header" and parts[0] in TEXT_HEADERS:
            continue
        if parts[-1] in MARKED or parts[0] in MARKED and all(x in MARKED or x in LAYOUT for x in parts[1:]):
            return True
    return False


class _Open(NamedTuple):
    """An open element and what it has from those around it."""

    tag: str
    number: int
    unread: bool = False
    plate: bool = False  # boilerplate by its tag or role
    mark: int = 0  # the nearest element on probation, itself included
    region: bool = False  # inside an article or main element


class _Line(NamedTuple):
    text: str
    links: int  # characters of it that are link text
    tags: int
    element: int
    plate: bool
    mark: int


class _Lines(HTMLParser):
    """Collects the lines of a page; elements are numbered in order, each with the number of its parent, 0 the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.open = [_Open("", 0)]
        self.kinds, self.parents = [""], [0]
        self.marks: dict[int, int] = {}  # elements on probation, each with the next one around it
        self.talk: set[int] = set()
        self.text: list[str] = []
        self.tags = self.links = self.anchors = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            top = self.open[-1]
            self.lines.append(_Line(text, min(self.links, len(text)), max(1, self.tags), top.number, top.plate, top.mark))
            self.tags = 0
        self.links = 0

    def shut(self, size: int) -> None:
        """Close elements until ``size`` are open."""
        for element in self.open[size:]:
            self.anchors -= element.tag == "a"
        del self.open[size:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
            while self.open[-1].tag == "p" or self.open[-1].tag == tag and tag in ENDED_BY_BLOCK:
                self.shut(len(self.open) - 1)
            for back in range(2, min(5, len(self.open))):
                if self.open[-back].tag == "p":  # inline tags left open do not keep a paragraph open over the next block
                    self.shut(len(self.open) - back)
                    break
        elif tag in ("br", "td", "th"):
            self.text.append(" ")
        if tag in VOID:
            return
        _, parent, unread, plate, mark, inside = self.open[-1]
        number = len(self.kinds)
        outer = tag in REGIONS and not inside
        if outer:
            unread, plate, mark = False, False, 0
        unread = unread or tag in UNREAD
        plate = plate or tag in BOILERPLATE or tag == "header" and not inside
        doubtful = tag == "form"
        if tag not in ("html", "body"):
            for name, value in attrs:
                value = (value or "").lower()
                if name in ("class", "id"):
                    talk = not TALK.isdisjoint(_PARTS.findall(value))
                    if marked(value) and (talk or not outer):
                        doubtful = True
                        if talk:
                            self.talk.add(number)
                elif outer:
                    continue
                elif name == "role":
                    plate = plate or value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert")
                elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", "") or name == "aria-hidden" and value == "true":
                    unread = True
        if doubtful:
            self.marks[number] = mark
            mark = number
        self.anchors += tag == "a"
        self.open.append(_Open(tag, number, unread, plate, mark, inside or tag in REGIONS))
        self.kinds.append(tag)
        self.parents.append(parent)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and tag not in BLOCKS:
            self.shut(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                self.shut(k)
                return
            if tag not in BLOCKS and self.open[k].tag in BLOCKS:
                return  # an inline end tag does not close the blocks opened since
            if self.open[k].tag in REGIONS and tag not in ("body", "html", "main", "article"):
                return  # a stray end tag does not close the region around it

    def handle_data(self, data: str) -> None:
        if not self.open[-1].unread:
            self.text.append(data)
            if self.anchors:
                self.links += len(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...]>`` of an unknown kind is a comment up to the next ``>``."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def close(self) -> None:
        if self.rawdata.startswith("<!--"):
            self.rawdata = ""  # a comment that never ends holds the rest of the page
        super().close()
        self.flush()


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; weights of missing neighbours are left out."""
    radius = math.ceil(2 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    full = lambda x: np.convolve(x, kernel)[radius : radius + len(x)]
    return full(ratios) / full(np.ones(len(ratios)))


def main_text(html: str) -> str:
    """The article text of one page, one block per line; empty if there is none."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    usable = [i for i, x in enumerate(lines) if not x.plate]
    if not usable:
        return ""
    smooth = smoothed(np.array([(len(x.text) - x.links) / x.tags for x in lines]))
    limit = smooth.std()
    if parser.marks:
        content = [i for i in usable if smooth[i] >= limit] or usable
        held = dict.fromkeys([0, *parser.marks], 0)
        for i in content:
            held[lines[i].mark] += len(lines[i].text)
        for element in sorted(parser.marks, reverse=True):
            held[parser.marks[element]] += held[element]
        total = sum(len(lines[i].text) for i in content)
        talk = parser.talk if any(not lines[i].mark for i in content) else ()
        stays = {0: True}
        for element in sorted(parser.marks):
            stays[element] = stays[parser.marks[element]] and 2 * held[element] > total and element not in talk
        usable = [i for i in usable if stays[lines[i].mark]]
    usable = [i for i in usable if _reads(parser, lines[i], smooth[i] >= limit)]
    if not usable:
        return ""
    content = [i for i in usable if smooth[i] >= limit] or usable
    votes = [0] * len(parser.kinds)
    for i in content:
        votes[lines[i].element] += len(lines[i].text)
    for element in range(len(votes) - 1, 0, -1):
        votes[parser.parents[element]] += votes[element]
    regions = [e for e, kind in enumerate(parser.kinds) if kind in REGIONS and votes[e]]
    if regions:
        best = max(regions, key=lambda e: (votes[e], parser.kinds[e] == "article", -e))
        chosen = {e for e in regions if parser.kinds[e] == parser.kinds[best] and 2 * votes[e] >= votes[best]}
    else:
        holders = [e for e, kind in enumerate(parser.kinds) if 2 * votes[e] > votes[0] and kind in BLOCKS and kind not in ENDED_BY_BLOCK]
        chosen = {max(holders, default=0)}
    inside = [0 in chosen]
    for element in range(1, len(votes)):
        inside.append(element in chosen or inside[parser.parents[element]])
    return "\n".join(lines[i].text for i in usable if inside[lines[i].element])


def _reads(parser: _Lines, line: _Line, dense: bool) -> bool:
    """Whether a line is no line of links."""
    if 5 * line.links < 4 * len(line.text):
        return True
    kind, around = parser.kinds[line.element], parser.kinds[parser.parents[line.element]]
    return kind in HEADINGS or around in HEADINGS or kind == "p" and dense


def extracted(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """All columns of ``pages`` with the main text of each whole page in ``out``.

    Null and empty pages, and pages without text, give an empty string. A column already called
    ``out`` is replaced; other columns stay. Every row stands alone: nothing is shuffled.
    """
    kept = [c for c in pages.columns if c != out]
    picked, names, fields = beside(pages, kept, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = [main_text(x.decode()) for x in texts_of(batch.column(len(kept)))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*names, "text"])

    return picked.mapInArrow(run, ", ".join([*fields, "text string"])).toDF(*kept, out)
