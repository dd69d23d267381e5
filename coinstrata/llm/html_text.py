"""Main text of web pages by text-to-tag ratio.

A page goes through the standard library's event parser in slices. The events make lines:
runs of text between block elements, each with its characters, its linked characters and
its tags. A line's ratio is its unlinked characters by its tags. The ratios, smoothed with
a Gaussian over neighbouring lines, are cut at their standard deviation: lines above it are
content, and the elements that hold them are the content regions, from which all lines are
taken, short ones and headings too.

Elements that say by their name, role or class that they are no article text (menus,
notices, forms, ...) are passed over while parsing, so that they are in no region.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinstrata.llm.common import carried

#: Characters that are given to the parser at once.
FEED_CHARS = 1 << 16
#: Standard deviation, in lines, of the Gaussian, and where it is cut off.
SIGMA, RADIUS = 1.0, 2
#: Lines of whose text a larger share is linked are menus, unless their region is an
#: article by name or their ratio makes them content.
LINKED = 0.5

# Elements of HTML by what they do.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html"
    " legend li main menu nav ol optgroup option p pre search section summary table tbody td"
    " tfoot th thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LEAVES = _HEADINGS | frozenset("p li dt dd pre td th caption figcaption summary address".split())
#: Containers whose content belongs to the element around them.
_LOOSE = frozenset(
    "ul ol dl table thead tbody tfoot tr blockquote figure details hgroup center".split()
)
_ARTICLES = frozenset(("article", "main"))
_PASSED = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head iframe input map menu"
    " meter nav noembed noframes noscript object option output progress script search select"
    " style svg template textarea title video".split()
)
_PASSED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation"
    " search status tablist toolbar".split()
)
#: Words in a class or id that mark an element as no article text.
_PASSED_WORDS = frozenset(
    "ad ads adsense advert advertisement advertisements advertising adverts aside breadcrumb"
    " breadcrumbs comment commentlist comments consent cookie cookies copyright discussion"
    " disqus footer footnav gdpr login masthead menu menus modal nav navbar navigation newsletter"
    " notice notices notification overlay pager pagination paywall popup popover promo promoted"
    " promotion recommended recommendations related replies respond responses search share"
    " sharing sharebar shoutbox sidebar sidenav signin signup skip social sponsor sponsored"
    " subscribe subscription toolbar topbar topnav widget widgets".split()
)
#: Words that do so outside articles only, where they name the page's own head.
_PASSED_OUTSIDE = frozenset("banner header".split())
_OF_ARTICLES = frozenset("article content entry post story title".split())
#: First words of class names that speak of other elements ("has-sidebar").
_ABOUT_OTHERS = frozenset("has no not with without".split())
#: Elements that a start tag of the same set ends, up to the element that bounds them.
_SIBLINGS = {
    "li": (frozenset(("li",)), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(("dl",))),
    "dd": (frozenset("dt dd".split()), frozenset(("dl",))),
    "tr": (frozenset("tr td th".split()), frozenset("table thead tbody tfoot".split())),
    "td": (frozenset("td th".split()), frozenset(("tr", "table"))),
    "th": (frozenset("td th".split()), frozenset(("tr", "table"))),
}
_TOKEN = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


@dataclass(slots=True)
class Element:
    tag: str
    number: int  # of the block that it is, or is in
    block: bool
    passed: bool = False  # this element, not one around it, is passed over


@dataclass
class Line:
    """A run of text in one block. ``block`` is its number."""

    block: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    tags: int = 0
    text: str = ""


class PageLines(HTMLParser):
    """The lines of a page. ``parent``, ``tag`` and ``article`` describe its blocks by
    number; block 0 is the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[Element] = []
        self.open: dict[str, int] = {}
        self.passing = 0
        self.parent, self.tag, self.article = [-1], ["html"], [False]
        self.lines: list[Line] = []
        self.line = Line(0)

    # Line numbers of the source are not needed.
    def updatepos(self, i: int, j: int) -> int:
        return j

    # The base class knows few kinds of marked sections and fails at others; in HTML all are
    # comments.
    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def finish(self) -> None:
        """The rest of the page. An unfinished tag or comment at its end is no text."""
        rest, self.rawdata = self.rawdata, ""
        if rest and not self.cdata_elem and not rest.startswith("<"):
            self.handle_data(unescape(rest))
        self._end_line()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        block = tag in _BLOCKS
        if block:
            self._end_line()
            self._end_implied(tag)
        else:
            self.line.tags += 1
        if tag in _VOID:
            if tag == "br" and not self.passing:
                self.line.parts.append(" ")
            return
        number = self.stack[-1].number if self.stack else 0
        element = Element(tag, number, block)
        if self.passing or self._is_passed(tag, attrs, self.article[number]):
            element.passed = True
            self.passing += 1
        elif block:
            element.number = len(self.tag)
            self.parent.append(number)
            self.tag.append(tag)
            named = tag in _ARTICLES or any(
                (name == "role" and value == "main") or (name == "itemprop" and value == "articleBody")
                for name, value in attrs
            )
            self.article.append(self.article[number] or named)
        self.stack.append(element)
        self.open[tag] = self.open.get(tag, 0) + 1
        if block:
            self._new_line()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # as in HTML, where only void elements end here

    def handle_endtag(self, tag: str) -> None:
        block = tag in _BLOCKS
        if block:
            self._end_line()
        else:
            self.line.tags += 1
            if tag == "br" and not self.passing:
                self.line.parts.append(" ")
        if self.open.get(tag):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i].tag == tag:
                    self._close_down_to(i)
                    break
                if self.stack[i].block and not block:
                    break  # an inline end tag ends nothing outside its block
        if block:
            self._new_line()

    def handle_data(self, data: str) -> None:
        if self.passing or not data:
            return
        self.line.parts.append(data)
        if self.open.get("a"):
            self.line.linked += len("".join(data.split()))

    def _end_implied(self, tag: str) -> None:
        """An open paragraph ends where a block starts; items, cells and rows end where the
        next one starts."""
        bound = frozenset()
        ended = frozenset(("p",))
        if self.open.get("p"):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i].tag == "p":
                    self._close_down_to(i)
                    break
                if self.stack[i].block:
                    break
        if tag in _SIBLINGS:
            ended, bound = _SIBLINGS[tag]
            if any(self.open.get(t) for t in ended):
                last = None
                for i in range(len(self.stack) - 1, -1, -1):
                    if self.stack[i].tag in bound:
                        break
                    if self.stack[i].tag in ended:
                        last = i
                        if tag != "tr":
                            break
                    elif self.stack[i].block:
                        break
                if last is not None:
                    self._close_down_to(last)

    def _close_down_to(self, i: int) -> None:
        for element in self.stack[i:]:
            self.open[element.tag] -= 1
            self.passing -= element.passed
        del self.stack[i:]

    def _is_passed(self, tag: str, attrs: list, in_article: bool) -> bool:
        if tag in _PASSED or (tag == "header" and not in_article):
            return True
        if tag in ("html", "body") or tag in _ARTICLES and not in_article:
            attrs = [a for a in attrs if a[0] not in ("class", "id")]
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if not value:
                continue
            if name == "role" and value.lower() in _PASSED_ROLES:
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
            if name in ("class", "id"):
                for single in value.split():
                    words = [t.lower() for t in _TOKEN.findall(single)]
                    if not words or words[0] in _ABOUT_OTHERS:
                        continue
                    # "sideBar" and "side-bar" are the word "sidebar" too.
                    found = frozenset(words) | {a + b for a, b in zip(words, words[1:])}
                    if found & _PASSED_WORDS:
                        return True
                    if found & _PASSED_OUTSIDE and not in_article and not found & _OF_ARTICLES:
                        return True
        return False

    def _new_line(self) -> None:
        self.line = Line(self.stack[-1].number if self.stack else 0, tags=1)

    def _end_line(self) -> None:
        text = " ".join("".join(self.line.parts).split())
        if text:
            self.line.text = text
            self.lines.append(self.line)
            self.line.parts = []
        self._new_line()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Each value as the weighted mean of its neighbours; beyond the ends there are none."""
    weights = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    sums = np.convolve(ratios, weights)[radius : radius + len(ratios)]
    return sums / np.convolve(np.ones(len(ratios)), weights)[radius : radius + len(ratios)]


def content_lines(lines: list[Line]) -> np.ndarray:
    """Which lines have a smoothed ratio of at least the standard deviation of all."""
    sizes = np.array([len(line.text) for line in lines], dtype=np.float64)
    unlinked = np.maximum(sizes - [line.linked for line in lines], 0)
    level = smoothed(unlinked / np.maximum([line.tags for line in lines], 1))
    return (level >= level.std()) & (unlinked > 0)


def main_blocks(html: str | None) -> list[str]:
    """The blocks of main text of a page, in order."""
    if not html:
        return []
    page = PageLines()
    for start in range(0, len(html), FEED_CHARS):
        page.feed(html[start : start + FEED_CHARS])
    page.finish()
    lines = page.lines
    if not lines:
        return []
    content = content_lines(lines)
    regions = {_region(page, line.block) for line, main in zip(lines, content) if main}
    # The region of every block, from the outside in: numbers rise with depth.
    of_block = [-1] * len(page.tag)
    for number in range(len(page.tag)):
        outer = of_block[page.parent[number]] if number else -1
        of_block[number] = outer if outer >= 0 else number if number in regions else -1
    direct: dict[int, tuple[int, int]] = {}
    for i, line in enumerate(lines):
        if of_block[line.block] >= 0 and _owner(page, line.block) == of_block[line.block]:
            first, _ = direct.get(of_block[line.block], (i, i))
            direct[of_block[line.block]] = (first, i)
    kept = []
    for i, line in enumerate(lines):
        region = of_block[line.block]
        if region < 0:
            continue
        if not page.article[region] and not content[i]:
            first, last = direct.get(region, (i, i))
            if line.linked > LINKED * len(line.text.replace(" ", "")) or not first <= i <= last:
                continue
        kept.append(i)
    if kept and not any(page.tag[lines[i].block] == "h1" for i in kept):
        # A title outside its region, directly above it.
        above = [i for i in range(kept[0]) if page.tag[lines[i].block] == "h1"]
        kept = above[-1:] + kept
    return [lines[i].text for i in kept]


def _owner(page: PageLines, block: int) -> int:
    """The container to which a line of ``block`` belongs: past leaves, lists and tables."""
    while block > 0 and page.parent[block] >= 0 and page.tag[block] in _LEAVES | _LOOSE:
        block = page.parent[block]
    return block


def _region(page: PageLines, block: int) -> int:
    """The region of a content line: the outermost article around it, else its container."""
    if not page.article[block]:
        return _owner(page, block)
    while block > 0 and page.article[page.parent[block]]:
        block = page.parent[block]
    return block


def main_text(html: Column) -> Column:
    """The main text of a column of pages, blocks joined by an empty line."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(["\n\n".join(main_blocks(html)) for html in batch], dtype=object)

    return extract(html)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the columns ``text`` (main text) and ``n_chars`` (its code points),
    which replace columns of these names. One row out for each row in.

    Null and empty pages, and pages without text, have an empty text; very long pages are
    parsed whole; repeated rows stay repeated. Character references are decoded, white space
    (``str.split``'s, no-break spaces included) inside a block becomes one space, ``<br>``
    is white space. Broken markup is read as it comes: unclosed elements end with the
    element around them, an unfinished tag at the end of a page is dropped.
    """
    row = carried(pages, ["text", "n_chars"])
    made = pages.select(row.alias("row"), main_text(pages[html]).alias("text"))
    return made.select("row.*", "text", F.char_length("text").cast("long").alias("n_chars"))
