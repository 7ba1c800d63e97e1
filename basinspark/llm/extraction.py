"""HTML extraction: parser events, text-to-tag ratio per line, Gaussian smoothing and threshold clustering.

The standard library's parser streams events over the whole page. Text between block boundaries forms a line with its
characters, its tags and the region that holds it: the innermost element that groups blocks (article, main, section,
div, table cell, body). Ratios of characters to tags are smoothed over neighbouring lines; lines above a threshold (the
page's mean ratio, as a multiple) vote with their characters for their regions and all that hold these. The votes choose the
content: the articles, or else main, or else the region that the strongest votes lead to from the body down. Every line
inside it is kept, however short, with all its sections.

Lines inside menus, headers, footers, sidebars, forms, scripts, styles and templates never count. Those inside elements
whose class, id or role names an advert, a notice, a sidebar, a menu, sharing links or reader comments do not count either,
unless such an element holds most of the votes of the whole page and is, has or looks like its article: a mark in the class
of a wrapper hides no content.

Pages are independent rows; each runs in one task whole, and the parser's memory is that of one page.

Defined cases: NULL or empty html and pages without text give an empty text; unclosed and misnested elements end with
their parent; markup cut off at the end of the page is dropped; repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without content, which never open a level.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose whole content is no main text.
OUTSIDE = frozenset(
    "head title script style noscript template nav header footer aside form button select textarea iframe svg canvas object menu dialog".split()
)
#: Elements that group blocks.
REGIONS = frozenset("html body article main section div td th center".split())
#: Elements that begin and end a line.
BLOCKS = REGIONS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table tr thead tbody tfoot caption figure figcaption details summary address hr br hgroup".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Open elements that a new element of a kind ends, up to the nearest region.
IMPLIED_END = {"p": BLOCKS - {"br"}, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"})}
#: Words of class, id or role values that mark no main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal "
    "newsletter subscribe subscription paywall sidebar aside related recommended recommendations widget share sharing social breadcrumb breadcrumbs menu nav navbar "
    "navigation toolbar pagination pager header masthead footer foot comment comments commentlist disqus replies reply discussion respond login signup search "
    "complementary contentinfo copyright legal disclaimer skip".split()
)
#: Those of the marks that never name a wrapper of content.
SURE_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr popup modal newsletter subscribe subscription comment comments "
    "commentlist disqus replies reply respond login signup".split()
)
#: Words before a mark that take it back, as in has-sidebar.
TAKEN_BACK = frozenset("has have with no without".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")


@dataclass(frozen=True)
class ExtractionParameters:
    deviation: float = 1.0  # of the Gaussian over lines
    reach: int = 2  # lines on either side that it covers
    threshold: float = 0.8  # a line votes when its smoothed ratio reaches this multiple of the page's mean
    share: float = 0.2  # an article is content with this share of the votes of the strongest one
    most: float = 0.8  # from the body down, a region stands for all that holds it with this share of the votes
    marked_most: float = 0.6  # a marked element is content only with this share of the votes of the page
    links: float = 0.5  # outside of articles, a region with this share of its characters in links is a menu


@dataclass
class Line:
    region: int
    marks: tuple[int, ...] = ()
    pieces: list[str] = field(default_factory=list)
    tags: int = 0
    links: int = 0
    heading: bool = False


class LineCollector(HTMLParser):
    """Turns parser events into lines; ``hidden`` counts the open elements whose content never counts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool]] = []  # element, whether it hides its content, region it lies in, whether it is marked
        self.hidden = self.in_links = 0
        self.region = 0
        self.parents, self.names, self.region_marks = [-1], ["body"], [()]
        self.marks: tuple[int, ...] = ()  # numbers of the open marked elements
        self.sure: list[bool] = []  # of each marked element, whether its mark never names a wrapper
        self.semantic: list[bool] = []  # and whether it is or has an article or main
        self.lines = [Line(0)]

    def _break(self) -> None:
        if self.lines[-1].pieces or self.lines[-1].tags:
            self.lines.append(Line(self.region, self.marks))
        else:
            self.lines[-1].region, self.lines[-1].marks = self.region, self.marks

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_implied(tag)
        if tag in BLOCKS:
            self._break()
        self.lines[-1].tags += 1
        if tag in VOID:
            return
        found = marks_of(attrs) if tag not in ("html", "body") else set()
        hides = tag in OUTSIDE or None in found
        self.open.append((tag, hides, self.region, bool(found)))
        self.hidden += hides
        self.in_links += tag == "a"
        if found:
            self.marks = (*self.marks, len(self.sure))
            self.sure.append(bool(found & SURE_MARKS))
            self.semantic.append(False)
        if tag in ("article", "main") and not self.hidden:
            for mark in self.marks:
                self.semantic[mark] = True
        if tag in HEADINGS:
            self.lines[-1].heading = True
        if tag in REGIONS and not self.hidden:
            self.parents.append(self.region)
            self.names.append(tag)
            self.region_marks.append(self.marks)
            self.region = len(self.parents) - 1
        if tag in BLOCKS:
            self._break()
            self.lines[-1].heading |= tag in HEADINGS

    def _end_implied(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth][0]
            if tag in IMPLIED_END.get(name, ()):
                self._close(depth)
                return
            if name in REGIONS or name in OUTSIDE or (name in ("ul", "ol", "dl", "table") and tag != "p"):
                return

    def _close(self, depth: int) -> None:
        closed = self.open[depth:]
        self.hidden -= sum(hides for _, hides, _, _ in closed)
        self.in_links -= sum(name == "a" for name, *_ in closed)
        self.marks = self.marks[: len(self.marks) - sum(is_marked for *_, is_marked in closed)]
        block = any(name in BLOCKS for name, *_ in closed)
        self.region = self.open[depth][2]
        del self.open[depth:]
        if block:
            self._break()

    def handle_endtag(self, tag: str) -> None:
        self.lines[-1].tags += 1
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self._close(depth)
                return
            if self.open[depth][0] in REGIONS and tag not in REGIONS and tag not in OUTSIDE:
                return  # a stray end tag does not end what lies around the region

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.lines[-1].pieces.append(data)
            self.lines[-1].links += len(data.strip()) if self.in_links else 0


def marks_of(attrs: list[tuple[str, str | None]]) -> set[str | None]:
    """The marking words of class, id and role; None among them for an element that is not shown at all."""
    found: set[str | None] = set()
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            words = [w.lower() for w in WORD.findall(value)]
            found |= {w for before, w in zip(["", *words], words, strict=False) if w in MARKS and before not in TAKEN_BACK}
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            found.add(None)
    return found


def smoothed(ratios: np.ndarray, params: ExtractionParameters) -> np.ndarray:
    """Gaussian mean of each line and its neighbours; at the ends of the page over those that exist."""
    kernel = np.exp(-0.5 * (np.arange(-params.reach, params.reach + 1) / params.deviation) ** 2)
    sums = np.convolve(ratios, kernel)[params.reach : params.reach + len(ratios)]
    return sums / np.convolve(np.ones(len(ratios)), kernel)[params.reach : params.reach + len(ratios)]


def _votes(lines: list[tuple[Line, str]], params: ExtractionParameters) -> np.ndarray:
    """Characters of each line whose smoothed ratio reaches the threshold, 0 of the others."""
    ratios = smoothed(np.array([len(text) / max(1, line.tags) for line, text in lines]), params)
    sizes = np.array([len(text) for _, text in lines])
    return np.where(ratios >= params.threshold * ratios.mean(), sizes, 0)


def _unhidden(page: LineCollector, lines: list[tuple[Line, str]], params: ExtractionParameters) -> set[int]:
    """The marked elements that hold the content of the page."""
    votes = _votes(lines, params)
    own, voters = np.zeros(len(page.sure)), np.zeros(len(page.sure))
    for (line, _), n in zip(lines, votes, strict=True):
        for mark in line.marks:
            own[mark] += n
            voters[mark] += n > 0
    inside = {region for region, name in enumerate(page.names) if name in ("article", "main") and not page.region_marks[region]}
    inside = _inside(page, inside)
    plain = any(text and line.region in inside for line, text in lines)
    return {
        mark
        for mark in range(len(page.sure))
        if votes.sum() and own[mark] >= params.marked_most * votes.sum() and ((page.semantic[mark] or voters[mark] >= 3) if not page.sure[mark] else (page.semantic[mark] and not plain))
    }


def _inside(page: LineCollector, wanted: set[int]) -> set[int]:
    """The wanted regions and all that lie in them; parents come before their children."""
    found = set(wanted)
    for region, parent in enumerate(page.parents):
        if parent in found:
            found.add(region)
    return found


def _content(page: LineCollector, lines: list[tuple[Line, str]], params: ExtractionParameters) -> set[int]:
    """The regions whose lines are the main text, all that lie in them included."""
    votes, own = _votes(lines, params), np.zeros(len(page.parents))
    chars, links = np.zeros(len(page.parents)), np.zeros(len(page.parents))
    for (line, text), n in zip(lines, votes, strict=True):
        own[line.region] += n
        chars[line.region] += len(text)
        links[line.region] += line.links
    for region in range(len(page.parents) - 1, 0, -1):  # children come after their parents
        for sums in (own, chars, links):
            sums[page.parents[region]] += sums[region]
    for name in ("article", "main"):
        every = {r for r, other in enumerate(page.names) if other == name}
        nested = _inside(page, every) - every | {r for r in every if page.parents[r] in _inside(page, every)}
        found = [r for r in sorted(every - nested) if chars[r]]
        if found:
            strongest = max(own[r] for r in found)
            return _inside(page, {r for r in found if own[r] >= params.share * strongest})
    best: dict[int, int] = {}
    for region in range(1, len(page.parents)):
        parent = page.parents[region]
        if parent not in best or own[region] > own[best[parent]]:
            best[parent] = region
    path = [0]
    while path[-1] in best and own[best[path[-1]]] and own[best[path[-1]]] >= params.most * own[path[-1]]:
        path.append(best[path[-1]])
    # A heading beside the strongest region belongs to it, so what holds both is the content.
    step = {region: i for i, region in enumerate(path)}
    deepest = len(path) - 1
    for line, text in lines:
        if line.heading and text:
            region = line.region
            while region not in step:
                region = page.parents[region]
            deepest = min(deepest, step[region])
    anchor = path[deepest]
    kept = {anchor}
    for region in range(anchor + 1, len(page.parents)):
        if page.parents[region] in kept and links[region] < params.links * max(1, chars[region]):
            kept.add(region)
    return kept


def main_text(html: str | None, params: ExtractionParameters = ExtractionParameters()) -> str:
    """The blocks of the content of one page, one to a line."""
    page = LineCollector()
    page.feed(html or "")
    if "<" not in page.rawdata:
        page.close()
    lines = [(line, SPACE.sub(" ", "".join(line.pieces)).strip()) for line in page.lines]
    shown = _unhidden(page, lines, params) if page.sure and any(text for _, text in lines) else set()
    lines = [(line, text) for line, text in lines if shown.issuperset(line.marks)]
    if not any(text for _, text in lines):
        return ""
    content = _content(page, lines, params)
    return "\n".join(text for line, text in lines if text and line.region in content)


def _extracted(params: ExtractionParameters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, params) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return run


def extracted(pages: DataFrame, params: ExtractionParameters = ExtractionParameters(), page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page with its main text and the number of its code points."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    schema = f"page_id {rows.schema[0].dataType.simpleString()}, url {rows.schema[1].dataType.simpleString()}, text string, n_chars long"
    return rows.mapInArrow(_extracted(params), schema)
