"""Main text of web pages by text-to-tag ratio.

Events of the standard library's streaming parser become blocks ("lines" of the page): text between block-level tags, with
the number of tags in it and the element it stands in. Each block's ratio of text to tags is smoothed with a Gaussian; a
threshold clusters blocks into content and other; the content region is the element that holds most of the content's
text, without what markup names as menus, notices, adverts, forms or comments. A class or id only raises a suspicion: an
element so named stays if it holds the page's article or most of its text, and inside an article what reads as content.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a page that the parser is fed at a time.
CHUNK = 1 << 16
#: Standard deviation of the smoothing, in blocks, and how many it reaches on either side.
SIGMA, REACH = 1.0, 2
#: A content region holds at least this share of the text of the blocks over the threshold.
SHARE = 0.9

# Names of the HTML standard, and names that pages commonly give to what is not their article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
ENDS_P = BLOCK - frozenset("br caption legend li option optgroup tbody td tfoot th thead title tr".split())
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form frameset header iframe input label map math menu nav noframes noscript "
    "object script search select style svg template textarea title video".split()
)
REGION = frozenset("article main section div td body center".split())
ARTICLE = frozenset("article main".split())
LISTS = frozenset("ul ol dl menu table select".split())
NOT_ARTICLE = frozenset(
    "ad ads adbox adsense advert advertisement advertising adverts banner banners promo promotion sponsor sponsored menu menus nav navbar "
    "navigation breadcrumb breadcrumbs sidebar sidebars aside header masthead footer cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations comment "
    "comments commentlist disqus reply replies respond widget widgets toolbar pagination pager copyright disclaimer skip".split()
)
READERS = frozenset("comment comments commentlist disqus reply replies respond ad ads advert advertisement sponsored promo related".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Words before a name that speak of the page's layout, not of the element.
LAYOUT = frozenset("has with no without is".split())


@dataclass(eq=False)
class Element:
    tag: str
    parent: Element | None
    dropped: bool
    named: bool = False  # dropped for its name, not its tag
    out: bool = False  # it or an element above is dropped whatever it holds
    readers: bool = False  # named as comments or adverts
    depth: int = 0
    in_link: bool = False


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    links: int = 0
    text: str = ""


def _named(tag: str, attrs: list[tuple[str, str | None]]) -> set[str]:
    """What in the element's role, class or id names something that is not the article; "hidden" for a role."""
    if tag in ("html", "body", "main"):
        return set()
    names = READERS if tag == "article" else NOT_ARTICLE
    for key, value in attrs:
        if key == "hidden" or key == "role" and (value or "").strip().lower() in ROLES:
            return {"hidden"}
    found: set[str] = set()
    for key, value in attrs:
        if key in ("class", "id") and value:
            for name in value.split():
                words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower()) if w]
                if words and words[0] not in LAYOUT:
                    found |= names.intersection(words)
    return found


class _Blocks(HTMLParser):
    """Blocks of one page in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.top = Element("", None, False)
        self.stack = [self.top]
        #: Where in the stack the open elements of a tag are, and those that an end tag left out is not looked for beyond.
        self.open: dict[str, list[int]] = {}
        self.walls: dict[str, list[int]] = {"p": [], "list": [], "article": []}
        self.blocks: list[Block] = []
        self.block = Block(self.top)

    def cut(self) -> None:
        if self.block.parts:
            self.block.text = " ".join("".join(self.block.parts).split())
            if self.block.text:
                self.blocks.append(self.block)
        self.block = Block(self.stack[-1])

    @staticmethod
    def _walls(tag: str) -> Iterator[str]:
        if tag in REGION or tag in DROPPED:
            yield "p"
        if tag in LISTS or tag in REGION and tag != "td":
            yield "list"
        if tag in ARTICLE or tag == "body":
            yield "article"

    def push(self, element: Element) -> None:
        at = len(self.stack)
        self.open.setdefault(element.tag, []).append(at)
        for wall in self._walls(element.tag):
            self.walls[wall].append(at)
        self.stack.append(element)

    def drop(self, at: int) -> None:
        """Closes the elements from this place of the stack on; each is closed once, however deep a page is."""
        while len(self.stack) > at:
            tag = self.stack.pop().tag
            self.open[tag].pop()
            for wall in self._walls(tag):
                self.walls[wall].pop()

    def close_tag(self, tag: str, wall: str | None) -> None:
        """Closes the innermost open element of the tag, unless a wall stands within it."""
        places = self.open.get(tag)
        if places and (wall is None or not self.walls[wall] or self.walls[wall][-1] <= places[-1]):
            self.drop(places[-1])

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.cut()
            if tag in ENDS_P:
                self.close_tag("p", "p")
            elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                self.close_tag(tag, "list")
        above = self.stack[-1]
        names = _named(tag, attrs)
        named = bool(names)
        if tag in ("article", "main", "body") and above.dropped and not named:
            # a menu, header or form that was never closed, or that wraps the page, does not hide an article
            # what stands below an element that is out is out as well
            i = bisect_left(self.stack, True, key=lambda e: e.out) % len(self.stack)
            if not self.stack[i].named and self.stack[i].tag in ("nav", "header", "form", "menu", "label", "title"):
                if self.stack[i].tag == "form":
                    for e in self.stack[i:]:
                        e.dropped = e.out = e.named = False
                else:
                    self.drop(i)
                above = self.stack[-1]
        self.block.tags += 1
        dropped = named or tag in DROPPED
        if tag in VOID:
            self.block.element = self.stack[-1]
            return
        out = above.out or tag in DROPPED or "hidden" in names
        self.push(Element(tag, above, above.dropped or dropped, named, out, not names.isdisjoint(READERS - {"related"}), depth=above.depth + 1, in_link=above.in_link or tag == "a"))
        if tag in BLOCK or not self.block.parts:
            self.block.element = self.stack[-1]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag and tag not in BLOCK and tag not in DROPPED:
            self.drop(len(self.stack) - 1)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.cut()
        # a stray end tag closes nothing outside the article
        self.close_tag(tag, None if tag in ("article", "main", "body", "html") else "article")
        if tag in BLOCK:
            self.block.element = self.stack[-1]

    def handle_data(self, data):
        if self.stack[-1].out:
            return
        self.block.parts.append(data)
        if self.stack[-1].in_link:
            self.block.links += len(data)


def _smoothed(ratio: np.ndarray) -> np.ndarray:
    """Gaussian mean of each block's neighbourhood, which is cut at the page's ends."""
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    return np.convolve(ratio, kernel)[REACH:-REACH] / np.convolve(np.ones(len(ratio)), kernel)[REACH:-REACH]


def _content(blocks: list[Block], alone: bool = False) -> np.ndarray:
    """Which blocks are content: two clusters of smoothed ratios, told apart by their standard deviation, and blocks
    that are mostly links left out. With ``alone`` a block's own ratio must reach the threshold as well."""
    ratio = np.array([(len(b.text) - b.links) / (1 + b.tags) for b in blocks], float)
    smooth = _smoothed(np.maximum(ratio, 0))
    least = min(smooth.std(), smooth.max())
    on = (smooth >= least) & ((ratio >= least) | (not alone))
    return on & np.array([2 * b.links <= len(b.text) for b in blocks])


def _elements(blocks: list[Block]) -> tuple[list[Element], list[Element]]:
    """The elements that blocks stand in, each once: as met from the blocks upwards, and every one after those around it."""
    seen: set[Element] = set()
    met: list[Element] = []
    outer_first: list[Element] = []
    for b in blocks:
        chain, e = [], b.element
        while e is not None and e not in seen:
            seen.add(e)
            chain.append(e)
            e = e.parent
        met += chain
        outer_first += reversed(chain)
    return met, outer_first


def _below(blocks: list[Block], sizes: Iterable[int], outer_first: list[Element]) -> dict[Element, int]:
    """For each element the sizes of the blocks in it and in the elements below it."""
    held = dict.fromkeys(outer_first, 0)
    for b, n in zip(blocks, sizes):
        held[b.element] += n
    for e in reversed(outer_first):
        if e.parent is not None:
            held[e.parent] += held[e]
    return held


def _within(outer_first: list[Element], mark: Callable[[Element], bool]) -> set[Element]:
    """The elements that are marked or stand in one that is."""
    found: set[Element] = set()
    for e in outer_first:
        if e.parent in found or mark(e):
            found.add(e)
    return found


def _cleared(blocks: list[Block]) -> list[Block]:
    """The blocks without those of named elements, but for what a name alone must not hide: the page's main element,
    its largest article if no other is left, else the elements that hold most of its content; and in an article or
    main element what is content by its own ratio, if it is not named as comments or adverts."""
    if not any(b.element.dropped for b in blocks):
        return blocks
    on = _content(blocks, alone=True)
    met, outer_first = _elements(blocks)
    text = _below(blocks, (len(b.text) for b in blocks), outer_first)
    content = _below(blocks, (len(b.text) * bool(c) for b, c in zip(blocks, on)), outer_first)
    total = sum(len(b.text) for b, c in zip(blocks, on) if c)
    articles = [e for e in met if e.tag in ARTICLE and not e.named]
    # what is around a main element
    around: set[Element] = set()
    for e in reversed(outer_first):
        if e.parent is not None and (e in around or e.tag == "main" and not e.named):
            around.add(e.parent)
    kept = {e for e in around if e.named}
    suspected = _within(outer_first, lambda e: e.named and e not in kept)
    if all(e in suspected for e in articles):
        if articles:
            kept |= {e for e in _up(max(articles, key=text.__getitem__).parent) if e.named}
        else:
            readers = _within(outer_first, lambda e: e.readers)
            kept |= {e for e in met if e.named and 2 * content[e] > total and e not in readers}
        suspected = _within(outer_first, lambda e: e.named and e not in kept)
    by_readers = _within(outer_first, lambda e: e.readers and e.named and e not in kept)
    in_article = _within(outer_first, lambda e: e.tag in ARTICLE)
    # suspected elements, the outermost of which stands in an article
    excused = _within(outer_first, lambda e: e in suspected and e.parent not in suspected and e.parent in in_article)
    return [b for b, c in zip(blocks, on) if b.element not in suspected or c and b.element in excused and b.element not in by_readers]


def main_text(html: str) -> str:
    """The page's article: its blocks in page order, white space runs as one space, joined by one space."""
    parser = _Blocks()
    for at in range(0, len(html), CHUNK):
        parser.feed(html[at : at + CHUNK])
    parser.close()
    parser.cut()
    blocks = _cleared([b for b in parser.blocks if not b.element.out])
    if not blocks:
        return ""
    on = _content(blocks)
    if not on.any():
        on[:] = True
    met, outer_first = _elements(blocks)
    sizes = [len(b.text) * bool(c) for b, c in zip(blocks, on)]
    held, total = _below(blocks, sizes, outer_first), sum(sizes)
    # the region: an article or main element, else the innermost element, that holds most of the content
    most = [e for e in met if e.tag in REGION and held[e] >= SHARE * total]
    marked = [e for e in most if e.tag in ARTICLE]
    region = max(marked or most, key=lambda e: e.depth, default=parser.top)
    if not marked:
        # several articles of one page: all that are not inside one another
        several = _within(outer_first, lambda e: e.tag in ARTICLE)
        if several and sum(held[e] for e in several if e.parent not in several) >= SHARE * total:
            return " ".join(b.text for b in blocks if b.element in several)
    inner = _within(outer_first, lambda e: e is region)
    inside = [i for i, b in enumerate(blocks) if b.element in inner]
    if region.tag not in ARTICLE:
        # without an article's own element: from the first block of content to the last, without lists of links
        core = [i for i in inside if on[i]]
        inside = [i for i in inside if core and core[0] <= i <= core[-1] and (on[i] or 2 * blocks[i].links <= len(blocks[i].text))]
    return " ".join(blocks[i].text for i in inside)


def _up(e: Element | None) -> Iterator[Element]:
    while e is not None:
        yield e
        e = e.parent


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: the id and url as they were, text string (empty if none), n_chars long (code points).

    Null html counts as empty; malformed pages give what the parser makes of them. Repeated rows stay repeated, an empty
    table gives an empty one, other columns are not read.
    """

    @F.pandas_udf("string")
    def text_of(htmls: pd.Series) -> pd.Series:
        return htmls.map(main_text)

    rows = pages.select(F.col(id_col), F.col(url_col), text_of(F.coalesce(F.col(html_col).cast("string"), F.lit(""))).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
