"""Main text of web pages by text-to-tag ratio.

A streaming standard-library parser turns a page into lines, one for each block of text. Every
line has a ratio of text to tags, which is zero inside elements that are never main text (menus,
forms, adverts, notices, comments, ...). Where a page has article or main elements, lines outside
them weigh half. The ratios are smoothed with a Gaussian over the lines, and two-means clustering of
the smoothed ratios gives the threshold. Lines above it select content regions: the article or
container that they lie in, with all its short lines. A headline and a byline in elements of their own
right before a region belong to it; nothing behind it does.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from allocspark.llm.common import replace_columns, schema_with

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br "
    "script style noscript template button select option textarea iframe object svg canvas audio video map math".split())
#: Never main text, wherever they stand.
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea iframe object svg "
    "canvas audio video dialog menu map math".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of a class or id that mark an element as no main text.
HINTS = frozenset(
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices alert popup modal overlay sidebar aside rail nav navbar navigation menu breadcrumb breadcrumbs pagination pager "
    "footer header masthead topbar comment comments respond replies reply disqus discussion related recommended share sharing "
    "social newsletter subscribe subscription signup login toolbar widget widgets toc".split())
#: Words that outweigh a hint, as in class="article-header".
CONTENT_HINTS = frozenset("article post entry content main story body text".split())
COMMENT_HINTS = frozenset("comment comments respond replies reply disqus discussion".split())
#: An open element of the first kind ends where one of the second begins.
CLOSED_BY = {
    "p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
}
#: Weight of lines outside article and main elements on pages that have some.
OUTSIDE = 0.5
#: On a page with articles of which no line is chosen, a container beside them is the story if it has so
#: many chosen lines, and so many times the text of the articles.
STORY_LINES, STORY_SHARE = 3, 4
BYLINE_HINTS = frozenset("byline author authors dateline".split())
#: Words that a byline begins with.
_BYLINE = re.compile(r"(?:by|von|par|por|de)\s+\w", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KERNEL = [math.exp(-(d * d) / 2) for d in range(-2, 3)]
_WORD = re.compile(r"[a-z]+")


class _Lines(HTMLParser):
    """Collects ``lines``: (text, tags, dropped, container, article, heading, byline).

    Every tag costs the same however deep the page is: places of open elements are kept by tag.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, int, int, bool, bool]] = []
        self.language = None
        # Open elements: (tag, dropped, container, article, heading, byline), all but the first as they hold inside.
        self.stack: list[tuple[str, bool, int, int, bool, bool]] = [("", False, 0, 0, False, False)]
        self.places: dict[str, list[int]] = {}  # of open elements in the stack, by tag
        self.blocks = [0]  # places of those that aren't inline
        self.text: list[str] = []
        self.tags = 0
        self.made = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            _, dropped, container, article, heading, byline = self.stack[-1]
            self.lines.append((text, max(1, self.tags), dropped, container, article, heading, byline or bool(_BYLINE.match(text))))
            self.tags = 0
        self.text = []

    def _open(self, tag: str, *holds) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, *holds))

    def _close_to(self, place: int) -> None:
        while len(self.stack) > place:
            tag = self.stack.pop()[0]
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()

    def handle_starttag(self, tag, attrs):
        if tag == "html" and self.language is None:
            self.language = dict(attrs).get("lang")
        self.tags += 1
        if tag in INLINE:
            if tag == "br":
                self.text.append(" ")
            if tag not in VOID:
                _, dropped, container, article, heading, byline = self.stack[-1]
                self._open(tag, dropped or _is_dropped(tag, attrs, article), container, article, heading, byline)
            return
        self.flush()
        if tag in VOID:
            return
        # An open p, li, ... ends where a block begins that cannot stand in it.
        enders = CLOSED_BY.get(self.stack[self.blocks[-1]][0], ())
        if enders is None or tag in enders:
            self._close_to(self.blocks[-1])
        _, dropped, container, article, heading, byline = self.stack[-1]
        dropped = dropped or _is_dropped(tag, attrs, article)
        if tag in ("article", "main", "section", "div", "body", "td", "table"):
            self.made += 1
            container = self.made
        if tag in ("article", "main") and not article:
            article = self.made
        self._open(tag, dropped, container, article, heading or tag in HEADINGS, byline or tag == "address" or bool(_words(attrs) & BYLINE_HINTS))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag not in INLINE:
            self.flush()
        open_at = self.places.get(tag)
        # An inline end tag does not reach out of its block.
        if open_at and (tag not in INLINE or open_at[-1] > self.blocks[-1]):
            self._close_to(open_at[-1])

    def handle_data(self, data):
        if self.stack[-1][1] and not self.stack[self.blocks[-1]][1]:
            return  # a dropped inline element, as a script or a marked advert, in a block that stays
        self.text.append(data)


def _words(attrs) -> set[str]:
    """Words of the class and id."""
    if not attrs:
        return set()
    values = dict(attrs)
    return set(_WORD.findall(f"{values.get('class') or ''} {values.get('id') or ''}".lower()))


def _is_dropped(tag: str, attrs, article: int) -> bool:
    if tag in DROPPED or (tag == "header" and not article):
        return True
    if not attrs:
        return False
    values = dict(attrs)
    if "hidden" in values or values.get("aria-hidden") == "true" or values.get("role") in DROPPED_ROLES:
        return True
    if "none" in (values.get("style") or "").replace(" ", "").partition("display:")[2][:4]:
        return True
    words = _words(attrs)
    if tag in ("html", "body", "main", "article"):
        return bool(words & COMMENT_HINTS) and tag != "body" and tag != "html"
    return bool(words & HINTS) and (bool(words & COMMENT_HINTS) or not words & CONTENT_HINTS)


def smoothed(ratios: list[float]) -> list[float]:
    """Gaussian over the lines, normalised at the ends."""
    result = []
    for place in range(len(ratios)):
        weights = total = 0.0
        for step, weight in enumerate(KERNEL, -2):
            if 0 <= place + step < len(ratios):
                weights += weight
                total += weight * ratios[place + step]
        result.append(total / weights)
    return result


def threshold(values: list[float]) -> float:
    """Border between the two clusters of ``values`` (two-means from the ends); at most their maximum."""
    low, high = min(values), max(values)
    for _ in range(20):
        border = (low + high) / 2
        below, above = [v for v in values if v < border], [v for v in values if v >= border]
        if not below or not above:
            break
        means = sum(below) / len(below), sum(above) / len(above)
        if means == (low, high):
            break
        low, high = means
    return (low + high) / 2


def main_text(html: str | None) -> tuple[str, str | None]:
    """(main text, declared language) of a page; the text is empty if the page has none."""
    if not html:
        return "", None
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.lines
    if not any(not line[2] for line in lines):
        return "", parser.language
    # An article or main element is evidence of its own, but the ratios decide.
    marked = any(line[4] and not line[2] for line in lines)
    ratios = smoothed([0.0 if dropped else len(text) / tags * (OUTSIDE if marked and not article else 1.0)
                       for text, tags, dropped, _, article, *_ in lines])
    border = threshold(ratios)
    chosen = [i for i, line in enumerate(lines) if not line[2] and ratios[i] >= border]
    if not chosen:
        chosen = [max((i for i, line in enumerate(lines) if not line[2]), key=lambda i: ratios[i])]
    inside = _region(lines, chosen, marked, ratios)
    return "\n".join(lines[i][0] for i in sorted(inside | _heads(lines, inside))), parser.language


def _region(lines: list[tuple], chosen: list[int], marked: bool, ratios: list[float]) -> set[int]:
    """Places of the undropped lines of the region that the chosen ones select.

    With articles: those that hold chosen lines. If none does, the container of the chosen lines if
    it looks like a story beside a teaser, else the article with the highest ratio. Without articles:
    the chosen lines' containers and what stands between.
    """
    if not marked:
        containers = {lines[i][3] for i in chosen}
        return {i for i, line in enumerate(lines) if not line[2] and (line[3] in containers or chosen[0] <= i <= chosen[-1])}
    articles = {lines[i][4] for i in chosen if lines[i][4]}
    if not articles:
        kept, told = {}, 0
        for text, _, dropped, _, article, *_ in lines:
            told += len(text) if article and not dropped else 0
        for i in chosen:
            kept.setdefault(lines[i][3], []).append(i)
        stories = {c for c, places in kept.items() if len(places) >= STORY_LINES
                   and sum(len(lines[i][0]) for i in places) >= STORY_SHARE * told}
        if stories:
            return {i for i, line in enumerate(lines) if not line[2] and line[3] in stories}
        articles = {lines[max((i for i, line in enumerate(lines) if line[4] and not line[2]), key=lambda i: ratios[i])][4]}
    return {i for i, line in enumerate(lines) if not line[2] and line[4] in articles}


def _heads(lines: list[tuple], inside: set[int]) -> set[int]:
    """Places of a headline and bylines right before a region that doesn't begin with a headline itself."""
    found: set[int] = set()
    for first in inside:
        if first - 1 in inside or lines[first][5]:
            continue
        before, at = [], first - 1
        while at >= 0 and at not in inside and not lines[at][2] and not lines[at][4] and (lines[at][5] or lines[at][6]):
            before.append(at)
            if lines[at][5]:
                found.update(before)
                break
            at -= 1
    return found


def extract_main_text(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Every row of ``df`` with text, n_chars (code points) and declared_lang in place of the html.

    A null, empty or text-free page gives an empty text; declared_lang is the ``lang`` of the html
    element, null where it has none. Markup that is cut off or not closed is read as far as it
    goes, in time linear in the page. Rows are independent, so repeated rows are alike and an empty table
    stays empty. Input columns named like a result column are replaced.
    """
    kept = replace_columns(df, ["text", "n_chars", "declared_lang", html_col])
    rows = df.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(f"`{html_col}`").cast("string").alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(html) for html in batch.column(batch.num_columns - 1).to_pylist()]
            texts = [text for text, _ in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                 pa.array([lang for _, lang in found], pa.string())],
                names=[*batch.schema.names[:-1], "text", "n_chars", "declared_lang"])

    schema = schema_with(kept, text="string", n_chars="long", declared_lang="string")
    return rows.mapInArrow(extract, schema)
