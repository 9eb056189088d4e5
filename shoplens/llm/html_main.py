"""Main text of HTML pages: text-to-tag ratios over parser events.

The standard library's streaming parser turns a page into lines (blocks), each
with its text, the tags seen since the line before, and its place in the
element tree.  Text-to-tag ratios of the lines are smoothed with a Gaussian
and split into two clusters by a threshold; the lines above it vote for the
element that holds the article, and every line of that element outside
boilerplate elements is kept, short paragraphs too.

Class and id words and <form> are evidence only: they do not count on an
element that holds most of the high-ratio text (of <article> and <main>, if
the page has them), nor when nothing else is left.

Defined results: NULL or empty HTML gives an empty text; a page without
content lines gives an empty text; malformed markup is read as far as it goes
(unclosed elements end with the page, a tag that never ends is left out,
unknown ``<![...`` sections are comments); the work is linear in lines and
elements, whatever their depth; repeated rows are extracted alike; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ship_package

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
NO_TEXT = frozenset(
    "script style noscript template head title svg math iframe object audio video canvas map select option "
    "datalist button textarea input label nav footer aside form menu dialog fieldset search".split()
)
SOFT = frozenset(("form", "fieldset"))  # may also wrap a whole page
PROSE = frozenset("p pre blockquote h1".split())  # content whatever the ratio
CONTAINERS = frozenset("html body main article section div center td".split())
CLOSES_P = BLOCKS - {"body", "html", "head", "title", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner nav "
    "navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer foot masthead topbar comment "
    "comments commentlist respond reply replies discussion disqus cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations widget login search pagination pager skip toolbar".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_WORD = re.compile(r"[A-Za-z]+")
_OPENS_TAG = re.compile(r"<[A-Za-z!/?]")


class Lines(HTMLParser):
    """Collects ``(text, tags, innermost element, boilerplate)`` per line (element -1: none).

    Elements are numbered as they open, so a parent's number is the smaller
    one.  ``hinted`` are the elements that only a hint calls boilerplate.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.names: list[str] = []  # element number -> name
        self.parents: list[int] = []  # element number -> parent's number, -1 without one
        self.hinted: set[int] = set()
        self.open: list[tuple[str, int, bool]] = []  # name, number, boilerplate
        self.inside: Counter[str] = Counter()  # open elements by name
        self.text: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            self.text = []
            if line:
                skip = bool(self.open) and self.open[-1][2]
                self.lines.append((line, self.tags, self.open[-1][1] if self.open else -1, skip))
                self.tags = 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS or tag in NO_TEXT:
            self.flush()
            if tag in CLOSES_P and self.inside["p"]:
                self._close("p")
            elif tag in ("li", "dt", "dd", "tr", "td", "th", "option") and self.open and self.open[-1][0] == tag:
                self._close(tag)
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        skip = self._is_boilerplate(tag, attrs)
        hint = not skip and self._is_hinted(tag, attrs)
        if tag in BLOCKS or tag in NO_TEXT or skip or hint:
            self.flush()
            inherited = bool(self.open) and self.open[-1][2]
            self.names.append(tag)
            self.parents.append(self.open[-1][1] if self.open else -1)
            self.inside[tag] += 1
            if hint:
                self.hinted.add(len(self.names) - 1)
            self.open.append((tag, len(self.names) - 1, inherited or skip))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.inside[tag]:
            self._close(tag)
        elif tag in BLOCKS:
            self.flush()
        self.tags += 1

    def handle_data(self, data):
        self.text.append(data)

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # not a section that the parser knows: a bogus comment
            return self.parse_bogus_comment(i, 0)

    def read(self, html: str):
        # behind the last ">" no tag can end: an open one there would be scanned again from every "<"
        rest = html.rfind(">") + 1
        tag = _OPENS_TAG.search(html, rest)
        self.feed(html[: tag.start()] if tag else html)
        self.close()
        self.flush()
        return self.lines

    def _close(self, tag: str) -> None:
        self.flush()
        while self.open:
            name = self.open.pop()[0]
            self.inside[name] -= 1
            if name == tag:
                return

    def inherited(self, elements) -> list[bool]:
        """For each element whether it or one around it is among ``elements``."""
        out: list[bool] = []
        for e, parent in enumerate(self.parents):
            out.append(e in elements or (parent >= 0 and out[parent]))
        return out

    def outermost(self, name: str) -> list[int]:
        """For each element the outermost one of this name around it (or itself), -1 without one."""
        out: list[int] = []
        for e, parent in enumerate(self.parents):
            above = out[parent] if parent >= 0 else -1
            out.append(above if above >= 0 else e if self.names[e] == name else -1)
        return out

    def totals(self, per_line) -> list[int]:
        """The sum of a number per line over the lines in each element."""
        out = [0] * len(self.names)
        for (_, _, e, _), n in zip(self.lines, per_line):
            if e >= 0:
                out[e] += n
        for e in range(len(out) - 1, -1, -1):
            if self.parents[e] >= 0:
                out[self.parents[e]] += out[e]
        return out

    def _is_boilerplate(self, tag: str, attrs) -> bool:
        if tag in NO_TEXT and tag not in SOFT:
            return True
        if tag == "header":  # the page's, not an article's own
            return not (self.inside["article"] or self.inside["main"])
        if tag in ("html", "body", "article", "main"):
            return False
        for key, value in attrs:
            if key == "role" and (value or "").lower() in ROLES - {"form"}:
                return True
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                return True
            elif key == "style" and "display:none" in (value or "").replace(" ", "").lower():
                return True
        return False

    def _is_hinted(self, tag: str, attrs) -> bool:
        if tag in SOFT:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        return any(
            (key == "role" and (value or "").lower() == "form")
            or (key in ("class", "id") and any(w.lower() in HINTS for w in _WORD.findall(value or "")))
            for key, value in attrs
        )


def smoothed_ratios(lines, sigma: float = 1.0) -> list[float]:
    """Characters per tag of each line, smoothed with a Gaussian over lines."""
    ratio = [len(text) / max(1, tags) for text, tags, _, _ in lines]
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(ratio)):
        total = weight = 0.0
        for d, k in zip(range(-reach, reach + 1), kernel):
            if 0 <= i + d < len(ratio):
                total += k * ratio[i + d]
                weight += k
        out.append(total / weight)
    return out


def threshold(values: list[float], rounds: int = 20) -> float:
    """Boundary of two clusters of the logarithms (1-D two-means)."""
    logs = [math.log1p(v) for v in values]
    cut = (min(logs) + max(logs)) / 2
    for _ in range(rounds):
        low = [v for v in logs if v < cut] or [min(logs)]
        high = [v for v in logs if v >= cut] or [max(logs)]
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return math.expm1(cut)


def _sizes(lines, chosen) -> list[int]:
    """Characters of the chosen lines, 0 for the others."""
    return [len(line[0]) if good else 0 for line, good in zip(lines, chosen)]


def without_wrappers(parser: Lines, lines, high: list[bool]) -> set[int]:
    """The hinted elements that are boilerplate: not those that hold the page's text."""
    named = parser.inherited({e for e, name in enumerate(parser.names) if name in ("article", "main")})
    hinted = parser.inherited(parser.hinted)
    sizes = _sizes(lines, high)
    clean = sum(n for n, (_, _, e, _) in zip(sizes, lines) if e < 0 or not hinted[e])
    total, mass = sum(sizes), parser.totals(sizes)
    inner = [n if e >= 0 and named[e] else 0 for n, (_, _, e, _) in zip(sizes, lines)]
    inner_total, inner_mass = sum(inner), parser.totals(inner)
    out = set()
    for e in parser.hinted:
        if inner_total:
            wraps = 2 * inner_mass[e] > inner_total and mass[e] > clean
        else:
            wraps = 2 * mass[e] > total
        if not wraps:
            out.add(e)
    return out


def article_elements(parser: Lines, lines, skipped: list[bool], content: list[bool]) -> set[int]:
    """The elements whose lines are the article; empty for the whole page."""
    sizes = _sizes(lines, content)
    total, mass = sum(sizes), parser.totals(sizes)
    # sibling articles count as one; <main> goes before an article that leaves out much of it
    groups: dict[int, set[int]] = {}
    mains: set[int] = set()
    main_of, article_of = parser.outermost("main"), parser.outermost("article")
    for (_, _, e, _), skip in zip(lines, skipped):
        if not skip and e >= 0:
            if main_of[e] >= 0:
                mains.add(main_of[e])
            if article_of[e] >= 0:
                groups.setdefault(parser.parents[article_of[e]], set()).add(article_of[e])
    articles = max(groups.values(), key=lambda g: sum(mass[e] for e in g), default=set())
    held = sum(mass[e] for e in articles)
    if held >= 0.8 * total and articles:
        return articles
    if 2 * sum(mass[e] for e in mains) > total:
        return mains
    if 2 * held > total:
        return articles
    # the deepest element around all content lines, but never a line's own element
    around, held_lines = parser.totals(map(int, content)), parser.totals(int(not skip) for skip in skipped)
    all_content = sum(content)
    common = max((e for e, n in enumerate(around) if n == all_content), default=-1)
    while common >= 0 and (parser.names[common] not in CONTAINERS or held_lines[common] < 2):
        common = parser.parents[common]
    return {common} if common >= 0 else set()


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by newlines."""
    if not html:
        return ""
    parser = Lines()
    lines = parser.read(html)
    hard = [line[3] for line in lines]
    if all(hard):
        return ""
    ratios = smoothed_ratios(lines)
    cut = threshold(ratios)
    in_prose = parser.inherited({e for e, name in enumerate(parser.names) if name in PROSE})
    prose = [line[2] >= 0 and in_prose[line[2]] for line in lines]
    high = [not skip and (r >= cut or p) for skip, r, p in zip(hard, ratios, prose)]
    if not any(high):
        high = [not skip for skip in hard]
    hints = without_wrappers(parser, lines, high) if parser.hinted else set()
    hinted = parser.inherited(hints)
    skipped = [skip or (line[2] >= 0 and hinted[line[2]]) for skip, line in zip(hard, lines)]
    if all(skipped):
        skipped = hard
    content = [not skip and good for skip, good in zip(skipped, high)]
    if not any(content):
        content = [not skip for skip in skipped]
    article = article_elements(parser, lines, skipped, content)
    inside = parser.inherited(article)
    return "\n".join(
        line[0] for line, skip in zip(lines, skipped) if not skip and (not article or (line[2] >= 0 and inside[line[2]]))
    )


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    ship_package(pages.sparkSession)

    def run(batches):
        for batch in batches:
            text = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(text, pa.string()),
                    pa.array([len(t) for t in text], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html_col)
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
