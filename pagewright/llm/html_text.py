"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block-level run of text.  Every line knows how much
of its text counts: none inside menus, headers, footers, sidebars, notices, adverts, forms
and comments, none inside links.  The counts are summed over sliding windows of ``WINDOW``
lines.  A surge point is a line where the sum rises above the threshold, a dive point one
where it falls to zero; the text between them is kept, short lines and lists of links too.

Where the page marks its article (``article`` or ``main``), the marks set the threshold: zero
for lines inside, so that no paragraph, however short, is lost; for lines outside the largest
sum inside (``OUTSIDE`` at least), so that a text next to a mere teaser is found and the rest
of the page is not.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.shared import slim

#: Lines of a window, and the characters above which a window counts as text on pages without an article.
WINDOW = 3
THRESHOLD = 80
#: The least threshold outside a marked article.
OUTSIDE = 1_000

_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " iframe legend li main menu nav noscript ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe noembed noframes svg math xmp select object canvas audio video".split())
_OUT_TAGS = frozenset("nav header footer aside form button label fieldset legend menu dialog datalist head".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status tablist".split())
_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos promotion promoted banner banners cookie cookies consent gdpr notice notices"
    " notification notifications alert alerts popup modal overlay newsletter subscribe subscription paywall signup signin login register sidebar sidebars aside widget widgets related"
    " recommended recommendations comment comments commentlist disqus reply replies respond discussion feedback nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager"
    " header masthead topbar footer bottombar share sharing social toolbar skip search searchform form copyright disclaimer".split()
)
#: Class words of layout wrappers, which may name a sidebar that they only stand beside.
_WRAPPERS = frozenset("with has no without wrapper container layout page content main site".split())
_COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())

_TOKEN = re.compile(r"<!--(?:.*?--!?>|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>?|<(?=[a-zA-Z])[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(source)} if source.strip(" /\n\t\r") else {}


def _excluded(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is no part of an article, judged by its tag, role, class and id."""
    if tag in ("html", "body", "main"):
        return False
    names = " ".join(attributes.get(k, "") for k in ("class", "id"))
    words = set(_WORD.findall(_CAMEL.sub(" ", names).lower()))
    if tag == "article":
        return bool(words & _COMMENT_WORDS)
    if tag in _OUT_TAGS or attributes.get("role", "").lower() in _OUT_ROLES:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    return bool(words & _OUT_WORDS) and not words & _WRAPPERS


class Line:
    """A block's text: ``counted`` characters outside links; ``out``: not part of an article; ``inside``: within one."""

    __slots__ = ("counted", "inside", "out", "text")

    def __init__(self, text: str, counted: int, out: bool, inside: bool):
        self.text, self.counted, self.out, self.inside = text, counted, out, inside


def lines_of(page: str) -> list[Line]:
    """The page's blocks in order, markup stripped, references decoded, white space folded."""
    found: list[Line] = []
    pieces: list[str] = []
    linked = 0
    stack: list[tuple[str, int, int]] = []  # tag, and what it adds to out_depth and in_depth
    out_depth = in_depth = link_depth = 0
    saved: list[tuple[int, int]] = []  # (stack height, out_depth) where an article suspends what it stands in

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                found.append(Line(text, max(0, len(text) - linked), out_depth > 0, in_depth > 0))
            pieces.clear()
        linked = 0

    def close(down_to: int) -> None:
        nonlocal out_depth, in_depth, link_depth
        while len(stack) > down_to:
            tag, out, inside = stack.pop()
            out_depth -= out
            in_depth -= inside
            link_depth -= tag == "a"
            if saved and saved[-1][0] == len(stack):
                out_depth = saved.pop()[1]

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            pieces.append(page[at:])
            break
        if m.start() > at:
            pieces.append(page[at : m.start()])
            if link_depth:
                linked += m.start() - at
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        block = tag in _BLOCK
        if closing:
            if block:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if block:
            flush()
            if tag not in ("br", "hr") and stack and stack[-1][0] == "p":
                close(len(stack) - 1)
            if tag in ("li", "dd", "dt", "option") and stack and stack[-1][0] == tag:
                close(len(stack) - 1)
        if tag in _VOID:
            continue
        if tag in _RAW:  # its content is no text of the page
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if not m[3].endswith("/"):
                at = stop.end() if stop else end
            continue
        if m[3].endswith("/") and tag not in _BLOCK:
            continue
        attributes = _attributes(m[3])
        out = _excluded(tag, attributes)
        inside = tag in ("article", "main") and not out
        if inside and out_depth and not in_depth:  # an unclosed menu, or a form around the whole page
            saved.append((len(stack), out_depth))
            out_depth = 0
        if tag == "a":
            link_depth += 1
        stack.append((tag, int(out), int(inside)))
        out_depth += out
        in_depth += inside
    flush()
    return found


def window_sums(counts: list[int], window: int = WINDOW) -> list[int]:
    """Sums of the counts of each line and the ``window`` - 1 lines after it."""
    sums, total = [0] * len(counts), 0
    for k in range(len(counts) - 1, -1, -1):
        total += counts[k] - (counts[k + window] if k + window < len(counts) else 0)
        sums[k] = total
    return sums


def surge_and_dive(counts: list[int], window: int = WINDOW, threshold: int = 0) -> list[tuple[int, int]]:
    """Ranges [surge, dive) of lines: a window's sum rises above the threshold, and later falls to zero."""
    ranges, start = [], -1
    for k, total in enumerate(window_sums(counts, window)):
        if start < 0 and counts[k] and total > threshold:
            start = k
        elif start >= 0 and total == 0:
            ranges.append((start, k))
            start = -1
    if start >= 0:
        ranges.append((start, len(counts)))
    return ranges


def main_text(page: str | None, window: int = WINDOW, threshold: int = THRESHOLD, outside: int = OUTSIDE) -> str:
    """The article's text; empty for null, empty and textless pages."""
    if not page:
        return ""
    lines = lines_of(page)
    article = [line.inside and not line.out for line in lines]
    within = [len(line.text) if a else 0 for line, a in zip(lines, article, strict=True)]
    # mostly links: a menu without a name
    beside = [line.counted if not line.out and not a and 2 * line.counted > len(line.text) else 0 for line, a in zip(lines, article, strict=True)]
    if any(within):
        threshold = max(outside, *window_sums(within, window))
    elif sum(beside) <= threshold:
        threshold = 0
    kept = [False] * len(lines)
    for s, e in surge_and_dive(within, window):
        kept[s:e] = [k or a for k, a in zip(kept[s:e], article[s:e], strict=True)]
    for s, e in surge_and_dive(beside, window, threshold):
        kept[s:e] = [True] * (e - s)
    return " ".join(line.text for line, k in zip(lines, kept, strict=True) if k and not line.out)


def _pages(window: int, threshold: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page, window, threshold) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame, window: int = WINDOW, threshold: int = THRESHOLD) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row, without a shuffle.

    Null, empty and textless pages give an empty text; repeated rows and rows that share an id
    are each extracted; very long pages are read whole; other columns are ignored; an empty
    table gives no rows.
    """
    rows = slim(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    return rows.mapInArrow(lambda b: _pages(window, threshold, b), "page_id long, url string, text string, n_chars long")
