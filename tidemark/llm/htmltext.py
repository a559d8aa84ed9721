"""HTML extraction (operator 2): text-to-tag ratios.

Events of the standard library's parser cut a page into lines, one for each
block; a line knows its text, its tags and the elements around it. Elements that
hold no article text are told by their name, role, or a whole token of their
class or id (``_token_says``; titles' and sections' ids say nothing). One that
only its class, or being a form, sets apart but that holds most of the page's
unlinked text is layout. Lines get their text-to-tag ratio (none inside what is
apart), a Gaussian smooths the ratios along the page, and two-means clustering
finds the threshold above which a line is content. Content lines vote, by
their length, for the region: the article or main element with most votes, or
where none is a fair part of the page the innermost container that holds all
content lines, widened while its parent adds only text. The region's lines are the text, short ones too.

Defined results: a null, empty or textless page gives an empty text; each row,
also a repeated one, its own result; an empty table an empty result; other
columns are ignored. Memory follows the longest page.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small "
                    "span strike strong sub sup td th time tt u var wbr".split())
#: Their content is not text of the page.
_SILENT = frozenset("script style noscript template title head iframe object svg math canvas audio video".split())
#: Their text isn't the article's.
_APART = frozenset("nav footer aside form button select textarea menu dialog fieldset".split())
_APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class and id attributes that say the same; the first ones also of
#: an element around an article.
_FOREIGN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr popup modal overlay "
    "paywall comment comments commentlist respond reply replies discussion disqus".split())
_APART_WORDS = _FOREIGN_WORDS | frozenset(
    "promo promotion promoted banner nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside rail widget "
    "widgets toolbar footer foot copyright legal masthead topbar header notice notices notification alert share sharing social "
    "follow related recommended newsletter subscribe subscription signup login search form".split())
#: Words that may stand beside those in a token without changing what it says.
_PLAIN_WORDS = frozenset(
    "site page main global local top bottom left right upper lower primary secondary inner outer list lists box boxes block "
    "section container wrapper wrap area bar links link buttons button icons icon posts articles stories items item group panel "
    "slot unit space zone placement content text title heading thread js ui".split())
_REGIONS = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Blocks of text, never a region.
_TEXT_BLOCKS = _INLINE | frozenset("p h1 h2 h3 h4 h5 h6 hgroup li dt dd ul ol dl blockquote pre address caption figcaption figure "
                                   "table thead tbody tfoot tr summary legend label center".split())


#: Why an element's text isn't the article's: by its name or role; by a word
#: that says so whatever is inside; by another word, or as a form.
_BY_NAME, _BY_FOREIGN_WORD, _BY_WORD = 1, 2, 3


def _token_says(token: str, words: frozenset) -> bool:
    """Whether a class token or id names one of ``words``: by itself
    (``footer``) or among plain words (``site-footer``), not in another phrase
    (``has-sidebar``, ``share-price``)."""
    parts = [w.lower() for w in _WORDS.findall(token)]
    return any(w in words for w in parts) and all(w in _APART_WORDS or w in _PLAIN_WORDS for w in parts)


class _Lines(HTMLParser):
    """Lines of a page: ``(text, tags, unlinked characters, path)``; path is the
    tuple of the numbers of the open elements, whose names and reasons to be
    apart are in ``names`` and ``reasons``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # name, number, silent
        self.names: list[str] = []
        self.reasons: list[int] = []
        self.lines: list[tuple[str, int, int, tuple[int, ...]]] = []
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def _end_line(self):
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((text, self.tags, max(0, len(text) - self.linked), tuple(e[1] for e in self.open)))
            self.parts = []
        self.tags = self.linked = 0

    def _reason(self, name: str, attrs) -> int:
        inside = any(e[0] in _REGIONS for e in self.open)
        if name in ("form", "fieldset"):
            return _BY_WORD
        if name in _APART or name == "header" and not inside:
            return _BY_NAME
        reason = 0
        for key, value in attrs:
            if not value:
                continue
            if key == "role" and value.strip().lower() in _APART_ROLES or key == "aria-hidden" and value == "true":
                return _BY_NAME
            if name in ("html", "body") or not (key == "class" or key == "id" and name not in _HEADINGS and name != "section"):
                continue
            for token in value.split():
                if _token_says(token, _FOREIGN_WORDS):
                    return _BY_FOREIGN_WORD
                if _token_says(token, _APART_WORDS - {"header"} if inside else _APART_WORDS):
                    reason = _BY_WORD
        return reason

    def _close(self, k: int):
        self._end_line()
        del self.open[k:]

    def handle_starttag(self, name, attrs):
        if name in _INLINE:
            self.tags += 1
            if name in ("br", "td", "th"):
                self.parts.append(" ")
            if name in _VOID:
                return
        else:
            self._end_line()
            if name in _VOID:
                return
            for k in range(len(self.open) - 1, -1, -1):  # a block ends an open paragraph
                if self.open[k][0] == "p":
                    self._close(k)
                    break
                if self.open[k][0] not in _INLINE:
                    break
        silent = self.open[-1][2] if self.open else False
        reason = 0 if name in _REGIONS else self._reason(name, attrs)
        if reason:
            self._end_line()
        self.open.append((name, len(self.names), silent or name in _SILENT))
        self.names.append(name)
        self.reasons.append(reason)

    def handle_startendtag(self, name, attrs):
        if name in _VOID:
            self.handle_starttag(name, attrs)
        else:
            self.handle_starttag(name, attrs)
            self.handle_endtag(name)

    def handle_endtag(self, name):
        if name in _INLINE:
            self.tags += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == name:
                if name not in _INLINE or self.reasons[self.open[k][1]]:
                    self._close(k)
                else:
                    del self.open[k:]
                return
            if name in _INLINE and self.open[k][0] not in _INLINE:
                return  # an inline end tag closes nothing beyond its block

    def handle_data(self, data):
        if not (self.open and self.open[-1][2]):
            self.parts.append(data)
            if any(e[0] == "a" for e in self.open):
                self.linked += len(data)

    def close(self):
        super().close()
        self._end_line()

    def apart(self) -> list[bool]:
        """Whether each line is apart."""
        reasons, names = self.reasons, self.names
        # what encloses an article by its class, or as a form, is its layout
        ruling = []
        for *_, path in self.lines:
            last = max((k for k, e in enumerate(path) if names[e] in _REGIONS), default=-1)
            ruling.append([e for k, e in enumerate(path) if reasons[e] and (reasons[e] != _BY_WORD or k > last)])
        total, held = 0, {}
        for (_, _, plain, _), ruled in zip(self.lines, ruling):
            if all(reasons[e] == _BY_WORD for e in ruled):
                total += plain
                for e in ruled:
                    held[e] = held.get(e, 0) + plain
        layout = {e for e, n in held.items() if 2 * n > total}
        return [any(e not in layout for e in ruled) for ruled in ruling]


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach:reach + len(ratios)] / weight


def two_means(values: np.ndarray) -> float:
    """Threshold between two clusters of values (least squares, exact)."""
    v = np.sort(values)
    n = len(v)
    if n < 2 or v[0] == v[-1]:
        return float(v[0]) if n else 0.0
    total, squares = np.cumsum(v), np.cumsum(v * v)
    k = np.arange(1, n)
    cost = squares[-1] - total[:-1] ** 2 / k - (total[-1] - total[:-1]) ** 2 / (n - k)
    cost[v[1:] == v[:-1]] = np.inf
    cut = int(np.argmin(cost))
    return float((v[cut] + v[cut + 1]) / 2)


def _held(weights: dict[tuple[int, ...], int]) -> dict[int, int]:
    """Weight of the lines inside each element."""
    out: dict[int, int] = {}
    for path, n in weights.items():
        for e in path:
            out[e] = out.get(e, 0) + n
    return out


def _common(paths, names: list[str]) -> tuple[int, ...]:
    """Path of the innermost container of all paths."""
    first, *more = paths
    for path in more:
        first = first[:next((k for k, (a, b) in enumerate(zip(first, path)) if a != b), min(len(first), len(path)))]
    return first[:next((k for k, e in enumerate(first) if names[e] in _TEXT_BLOCKS), len(first))]


def _region(votes: dict[tuple[int, ...], int], sizes: dict[tuple[int, ...], int], aparts: set[tuple[int, ...]],
            names: list[str]) -> int | None:
    """Number of the element that is the region; None for the whole page."""
    by_vote, by_size = _held(votes), _held(sizes)
    depth = {e: d for path in sizes for d, e in enumerate(path)}
    total = sum(votes.values())
    # an article or main element, unless it is a small part beside the content
    regions = [e for e in by_size if names[e] in _REGIONS and (2 * by_vote.get(e, 0) >= total or 4 * by_size[e] >= total)]
    if regions:  # of nested ones with equal votes the inner
        return max(regions, key=lambda e: (by_vote.get(e, 0), by_size[e], depth[e]))
    inner = _common(votes, names)
    while inner:  # wider while that brings no line of what is apart, or text that stands in the parent itself
        outer, e = inner[:-1], inner[-1]
        added = [x for x in sizes if x[:len(outer)] == outer and e not in x]
        mixed = any(x[:len(outer)] == outer and e not in x for x in aparts)
        if mixed and not all(names[x[k]] in _TEXT_BLOCKS for x in added for k in range(len(outer), len(x))):
            break
        inner = outer
    return inner[-1] if inner else None


def extract(html: str, sigma: float = 1.0) -> str:
    """Main text of a page, its blocks joined by an empty line."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    apart = np.array(parser.apart())
    size = np.array([len(x[0]) for x in lines], float)
    ratios = np.where(apart, 0.0, size / np.maximum(1, [x[1] for x in lines]))
    smoothed = smooth(ratios, sigma)
    content = (smoothed >= two_means(smoothed)) & ~apart
    if not content.any():
        content = ~apart
    if not content.any():
        return ""
    votes: dict[tuple[int, ...], int] = {}
    sizes: dict[tuple[int, ...], int] = {}
    for k in np.flatnonzero(~apart).tolist():
        text, path = lines[k][0], lines[k][3]
        sizes[path] = sizes.get(path, 0) + len(text)
        if content[k]:
            votes[path] = votes.get(path, 0) + len(text)
    aparts = {x[3] for x, a in zip(lines, apart) if a}
    region = _region(votes, sizes, aparts, parser.names)
    return "\n\n".join(x[0] for x, a in zip(lines, apart) if not a and (region is None or region in x[3]))


def main_text(pages: DataFrame, sigma: float = 1.0) -> DataFrame:
    """Per row of pages: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, _, _ in tb.slices(batch.column("html")):
                texts = [extract(h, sigma) if h else "" for h in batch.column("html").slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id").slice(lo, hi - lo), batch.column("url").slice(lo, hi - lo),
                     pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
