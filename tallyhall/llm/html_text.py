"""Main text of web pages, by the text-to-tag ratio of their lines.

The standard library's parser streams over a page. Block elements cut the page into lines;
a line knows its text, how many tags it holds, how much of it is links, the container it stands
in, and whether an element around it is boilerplate by name (``nav``, ``footer``, ``form``,
...), by role, or marked by a word of its class or id (``sidebar``, ``advert``, ``comments``, ...).
Marks yield to text: an ``article`` or ``main`` with a mark of its own keeps it only while
more text is found elsewhere, and where nothing else is left the marked element with the
most text counts, if links are the lesser part of it. The ratio of characters to tags is
smoothed over neighbouring lines by a Gaussian. Lines whose smoothed ratio reaches the
threshold (a share of the mean, plus a share of the deviation) form clusters; the smallest
container around all clustered text is the content region, and with it count all lines inside
it that are not boilerplate. An ``article`` or ``main`` that holds clustered text comes first, and with it
every other ``article`` that is not mostly links. A line costs the same however deep it stands.

Null and empty pages have no text, nor have pages of nothing but boilerplate; text without
any markup is one line and is kept. Rows are read one by one, so repeated rows need no
rule; further columns are ignored; an empty table gives an empty result. Broken markup:
an end tag closes what is open inside its element, a tag that never closes ends with its
parent, and if all articles and main regions lie in boilerplate, it was left open there.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhall.llm.common import slices, small_batches

CHUNK = 1 << 16  # characters fed to the parser at once
SIGMA = 1.0
MEAN_SHARE, DEVIATION_SHARE = 0.5, 0.1

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article main section div body td".split())
REGIONS = frozenset(["article", "main"])
BOILERPLATE = frozenset(
    "nav header footer aside form menu script style noscript template iframe object svg math canvas button select "
    "textarea option label input head title dialog audio video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split()
)
#: Words of class and id names that mark boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menus breadcrumb breadcrumbs sidebar side aside header masthead topbar footer foot cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations widget widgets comment comments disqus respond reply replies "
    "discussion pagination pager toolbar skip hidden".split()
)
#: Words that make a mark a remark on the layout, as in ``with-sidebar``.
ABOUT = frozenset("with has no without not".split())
NAME = re.compile(r"[a-z]+|[0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: Elements that a start of the same kind ends, where authors leave end tags out.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tr": {"table"}, "option": {"select"}, "p": CONTAINERS | {"li", "blockquote"}}


def marked(attributes: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """Whether a word of class or id marks an element, and whether its role or state does."""
    by_name = False
    for name, value in attributes:
        if value is None:
            if name == "hidden":
                return by_name, True
            continue
        if name in ("class", "id"):
            words = NAME.findall(CAMEL.sub(" ", value).lower())
            by_name |= any(w in MARKS and before not in ABOUT for before, w in zip(["", *words], words))
        elif name == "role" and value.strip().lower() in ROLES:
            return by_name, True
        elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            return by_name, True
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return by_name, True
    return by_name, False


class Line(NamedTuple):
    text: str
    tags: int
    links: int  # characters within links
    container: int
    region: int  # container that is the innermost article or main
    hard: bool  # boilerplate by element, role or style around it
    hard_within: bool  # of that, some within the region
    mark: int  # innermost marked element around it
    outer: int  # the same just outside the region


class Open(NamedTuple):
    tag: str
    hard: int
    hard_within: int
    mark: int
    outer: int
    container: int
    region: int


NONE = Open("", 0, 0, -1, -1, -1, -1)


class Lines(HTMLParser):
    """Cuts a page into lines. Containers and marked elements are numbered as they open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Open] = []
        self.count: Counter[str] = Counter()  # open elements by tag
        self.containers: list[int] = []  # the container around each
        self.regions: dict[int, str] = {}
        self.marks: list[tuple[int, bool]] = []  # the mark around each, and whether it is on a region
        self.text: list[str] = []
        self.tags = self.links = 0

    def cut(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            top = self.open[-1] if self.open else NONE
            self.lines.append(
                Line(text, max(1, self.tags), self.links, top.container, top.region, top.hard > 0, top.hard_within > 0, top.mark, top.outer)
            )
        self.text, self.tags, self.links = [], 0, 0

    def close_from(self, place: int) -> None:
        for gone in self.open[place:]:
            self.count[gone.tag] -= 1
        del self.open[place:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS and any(self.count[t] for t in ENDS[tag]):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i].tag in STOPS[tag]:
                    break
                if self.open[i].tag in ENDS[tag]:
                    self.cut()
                    self.close_from(i)
                    break
        if tag in BLOCKS or tag in BOILERPLATE:
            self.cut()
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.text.append(" ")
            return
        top = self.open[-1] if self.open else NONE
        container, region, mark, outer = top.container, top.region, top.mark, top.outer
        hard = tag in BOILERPLATE
        within = top.hard_within
        if tag in CONTAINERS:
            self.containers.append(container)
            container = len(self.containers) - 1
            if tag in REGIONS:
                self.regions[container] = tag
                region, outer, within = container, mark, 0
        if attrs and tag not in ("html", "body"):
            by_name, by_state = marked(attrs)
            hard |= by_state
            if by_name and not hard:
                self.marks.append((mark, tag in REGIONS))
                mark = len(self.marks) - 1
        self.open.append(Open(tag, top.hard + hard, within + hard, mark, outer, container, region))
        self.count[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1].tag == tag and tag in ("svg", "path", "use", "circle", "rect"):
            self.close_from(len(self.open) - 1)  # only foreign elements close themselves

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in BOILERPLATE:
            self.cut()
        self.tags += 1
        if self.count[tag]:
            i = len(self.open) - 1
            while self.open[i].tag != tag:
                i -= 1
            self.close_from(i)

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.count["a"]:
            self.links += len(data)


def smooth(ratios: np.ndarray) -> np.ndarray:
    reach = int(math.ceil(3 * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]
    return np.convolve(ratios, kernel)[reach:-reach] / weight  # the ends count what is there


def main_text(html: str | None) -> str:
    """The text of a page's content region, blocks joined by blanks."""
    if not html:
        return ""
    parser = Lines()
    for i in range(0, len(html), CHUNK):
        parser.feed(html[i : i + CHUNK])
    parser.close()
    parser.cut()
    lifted: set[int] = set()
    while True:
        kept = chosen_lines(parser, lifted)
        more = lift(parser, lifted, sum(len(parser.lines[i].text) for i in kept))
        if not more:
            return " ".join(parser.lines[i].text for i in kept)
        lifted |= more


def standing(parser: Lines, lifted: set[int]) -> list[int]:
    """How many marks hold around and at each marked element."""
    out: list[int] = []
    for i, (around, _) in enumerate(parser.marks):
        out.append((out[around] if around >= 0 else 0) + (i not in lifted))
    return [*out, 0]  # the last is for -1, no mark


def lift(parser: Lines, lifted: set[int], kept: int) -> set[int]:
    """Marks that yield: of regions with more text than is kept, or the largest if nothing is."""
    count = standing(parser, lifted)
    root: list[int] = []  # outermost mark that holds
    for i, (around, _) in enumerate(parser.marks):
        own = -1 if i in lifted else i
        root.append(root[around] if around >= 0 and root[around] >= 0 else own)
    text, links = Counter(), Counter()
    for line in parser.lines:
        if not line.hard and count[line.mark] == 1:
            text[root[line.mark]] += len(line.text)
            links[root[line.mark]] += line.links
    prose = {m: n for m, n in text.items() if 2 * links[m] < n}
    found = {m for m, n in prose.items() if parser.marks[m][1] and n > kept}
    if not found and not kept and prose:
        found = {max(prose, key=lambda m: (prose[m], -m))}
    return found


def chosen_lines(parser: Lines, lifted: set[int]) -> list[int]:
    """Lines of the content region, given the marks that don't count."""
    lines, count = parser.lines, standing(parser, lifted)
    bad = [line.hard or count[line.mark] > 0 for line in lines]
    if parser.regions and not any(line.region >= 0 for line, b in zip(lines, bad) if not b):
        # Every region lies in boilerplate, left open by mistake.
        bad = [line.hard_within or count[line.mark] > count[line.outer] for line in lines]
    clean = [i for i, b in enumerate(bad) if not b]
    if not clean:
        return []
    sizes = np.array([len(line.text) for line in lines], float)
    ratios = np.array([0.0 if b else size / line.tags for line, size, b in zip(lines, sizes, bad)])
    level = smooth(ratios)
    bar = MEAN_SHARE * level[clean].mean() + DEVIATION_SHARE * level[clean].std()
    clustered = [i for i in clean if level[i] >= bar] or clean
    chosen = {lines[i].region for i in clustered} - {-1}
    if chosen:
        text, links = Counter(), Counter()
        for i in clean:
            text[lines[i].region] += len(lines[i].text)
            links[lines[i].region] += lines[i].links
        prose = {r for r, n in text.items() if 2 * links[r] < n}
        chosen = (chosen & prose or chosen) | {r for r in prose if parser.regions.get(r) == "article"}
    else:
        # No article or main: the smallest container around all clustered lines, or the whole page.
        held = [0] * len(parser.containers)
        for i in clustered:
            if lines[i].container >= 0:
                held[lines[i].container] += 1
        for c in range(len(held) - 1, -1, -1):  # a container opens after the one around it
            if parser.containers[c] >= 0:
                held[parser.containers[c]] += held[c]
        around = [c for c, n in enumerate(held) if n == len(clustered)]
        if not around:
            return clean
        chosen = {around[-1]}
    inside: list[bool] = []
    for c, parent in enumerate(parser.containers):
        inside.append(c in chosen or parent >= 0 and inside[parent])
    return [i for i in clean if lines[i].container >= 0 and inside[lines[i].container]]


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                texts = [main_text(h) for h in batch.column("html").to_pylist()]
                yield pa.record_batch(
                    {
                        "page_id": batch.column("page_id"),
                        "url": batch.column("url"),
                        "text": pa.array(texts, pa.string()),
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    }
                )

    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return small_batches(pages).mapInArrow(read, "page_id long, url string, text string, n_chars long")
