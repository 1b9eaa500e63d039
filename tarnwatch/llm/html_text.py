"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element; elements that never are article text (menus,
headers, footers, sidebars, forms, scripts, adverts, notices, comments) become blank lines, and so
does all outside `article` or `main` where a page has text in one. The lengths of the lines, link
text not counted, are summed over a sliding window. A surge is where such a sum rises over the
threshold, a part of the page's largest sum; a dive is where it falls to nothing. The lines
between the dives around a surge are kept whole.

Elements are named by class, id and role. A name counts as a whole: `sidebar` and `site-header` hide,
`has-sidebar` and `comments-open` do not. Nothing hides html, body or main, nor what holds a main, the
longest article or most of the page's text; but comments, notices, footers and the like may be the
longest part of a page and are hidden while it has other text.

Defined cases: a null or empty page, and one without any text line, gives an empty text; an element
that is never closed does not hide what follows it; comments and raw text elements without an end
reach to the end of the page; `br` is white space.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: A surge needs this part of the largest window sum, but never more than this many characters.
SURGE_PART, SURGE_MOST = 0.3, 80

RAW = {"script", "style", "noscript", "template", "svg", "textarea", "iframe", "title", "select", "object"}
HIDDEN = RAW | {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog"}
CONTENT = {"article", "main"}
BLOCKS = CONTENT | HIDDEN | {
    "address", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "html", "li", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "overlay", "pagination",
    "popup", "promo", "promotion", "related", "replies", "respond", "share", "sharing", "sidebar", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget", "complementary", "contentinfo", "search"}
#: Words that leave a compound name what its other words say: `site-header`, `ad-slot`, but not `has-sidebar`.
NEUTRAL = {
    "alert", "area", "article", "aside", "author", "bar", "block", "blog", "body", "bottom", "box", "btn",
    "button", "buttons", "card", "container", "copyright", "div", "entry", "fixed", "floating", "form", "global",
    "google", "group", "holder", "icon", "icons", "inner", "item", "items", "left", "link", "links", "list", "main",
    "media", "message", "middle", "mobile", "mw", "outer", "page", "panel", "post", "posts", "primary", "reply", "right",
    "secondary", "section", "sections", "signup", "site", "slot", "sticky", "sub", "tags", "text", "thread", "title",
    "toggle", "top", "unit", "widgets", "wp", "wrap", "wrapper"}
COMMENTS = {"comment", "comments"}
#: Parts that may hold articles of their own.
OTHERS = COMMENTS | {"disqus", "replies", "respond", "related"}
#: Parts whose length says nothing against hiding them, as long as the page has other text.
APART = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "complementary", "consent", "contentinfo",
    "cookie", "cookies", "footer", "gdpr", "nav", "navigation", "newsletter", "sidebar"}
APART_TAGS = {"nav", "footer", "aside", "button", "menu", "dialog"}

TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>")
#: Searched in the page itself: `lower` moves places, as it makes two characters of some.
RAW_ENDS = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
CONCEALED = re.compile(r"(?:^|\s)(?:hidden(?=\s|=|/|$)|aria-hidden\s*=\s*[\"']?true)", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")


def hidden_kind(tag: str, attributes: str) -> int:
    """0: an element to keep, 1: to hide, 2: whatever its length, 3: even with the longest article in it."""
    if tag in ("html", "body", "main"):
        return 0
    kind = 2 if tag in APART_TAGS else int(tag in HIDDEN)
    if not attributes:
        return kind
    if tag != "article" and CONCEALED.search(attributes):
        kind = max(kind, 1)
    for found in NAMES.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").split():
            words = {w.lower() for w in WORD.findall(name)}
            if words & HIDDEN_NAMES and words <= HIDDEN_NAMES | NEUTRAL and (tag != "article" or words & COMMENTS):
                kind = max(kind, 3 if words & OTHERS else 2 if words & APART else 1)
    return kind


def events_of(page: str) -> list[tuple]:
    """The page in order: (text,), or (tag, opening, attributes); a raw element is its opening tag alone."""
    events, at = [], 0
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            events.append((page[at:],))
            break
        if start > at:
            events.append((page[at:start],))
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = len(page) if end < 0 else end + 1
            continue
        found = TAG.match(page, start)
        if not found:
            events.append(("<",))
            at = start + 1
            continue
        at = found.end()
        tag, opening = found[1].lower(), page[start + 1] != "/"
        events.append((tag, opening, found[2]))
        if opening and tag in RAW:
            end = RAW_ENDS[tag].search(page, at)
            at = end.start() if end else len(page)
    return events


def hidden_elements(events: list[tuple]) -> dict[int, int]:
    """First event of each element to hide, and the event that ends it.

    Hidden by tag or name, but not if it holds a `main`, the longest article, or most of the text.
    Lengths are differences of prefix sums, text of links not counted.
    """
    last = {e[0]: i for i, e in enumerate(events) if len(e) > 1 and not e[1]}
    before, everything = [0], [0]
    open_tags: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    kinds: dict[int, int] = {}
    contents = []
    in_link = False
    for i, event in enumerate(events):
        size = 0
        if len(event) == 1:
            size = len(event[0].strip())
        else:
            tag, opening, attributes = event
            if tag == "a":
                in_link = opening
            if opening and tag not in VOID and tag not in RAW and not attributes.endswith("/"):
                open_tags.setdefault(tag, []).append(i)
                kind = hidden_kind(tag, attributes)
                if kind and last.get(tag, -1) > i:
                    kinds[i] = kind
                elif tag in CONTENT:
                    contents.append(i)
            elif not opening and open_tags.get(tag):
                ends[open_tags[tag].pop()] = i
        everything.append(everything[-1] + size)
        before.append(before[-1] + (0 if in_link else size))
    if not before[-1]:
        before = everything

    def size_of(i):
        return before[ends.get(i, len(events))] - before[i]

    total = before[-1]
    main = next((i for i in contents if events[i][0] == "main" and size_of(i)), None)
    longest = max(contents, key=size_of, default=None)
    if longest is not None and not size_of(longest):
        longest = None
    outside, covered = total, 0
    for i in kinds:
        if i >= covered:
            covered = ends.get(i, len(events))
            outside -= size_of(i)
    hidden = {}
    for i, kind in kinds.items():
        end = ends.get(i, len(events))
        if main is not None and i < main < end:
            continue
        if longest is not None and i < longest < end:
            spared = (kind < 3 or not outside) and size_of(longest) >= outside
        else:
            # Within the longest article its length counts, beside it none does.
            within = longest is None or longest < i < ends.get(longest, len(events))
            spared = (kind < 2 or not outside) and within and 2 * size_of(i) > (
                total if longest is None else size_of(longest))
        if not spared:
            hidden[i] = end
    return hidden


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, characters outside links, inside article or main) per line; blank where things are hidden."""
    lines, parts = [], []
    free, in_link, inside = 0, 0, 0
    events = events_of(page)
    hidden, resume = hidden_elements(events), 0

    def close_line():
        nonlocal free
        text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        if text:
            lines.append((text, free, inside > 0))
        parts.clear()
        free = 0

    for i, event in enumerate(events):
        if i < resume:
            continue
        if len(event) == 1:
            parts.append(event[0])
            if not in_link:
                free += len(event[0].strip())
            continue
        tag, opening, attributes = event
        if tag in BLOCKS:
            close_line()
        elif tag in ("br", "td", "th"):
            parts.append(" ")
        if opening and tag in RAW:
            lines.extend([("", 0, inside > 0)] * (0 if inside else WINDOW))
            continue
        if i in hidden:
            close_line()
            resume = hidden[i] + 1
            lines.extend([("", 0, inside > 0)] * (0 if inside else WINDOW))
            continue
        if tag in CONTENT and not attributes.endswith("/"):
            inside = max(0, inside + (1 if opening else -1))
        if tag == "a":
            in_link = int(opening)
    close_line()
    return lines


def kept_lines(lengths: np.ndarray) -> np.ndarray:
    """Which lines lie between the dives around a surge."""
    n = len(lengths)
    total = np.concatenate([[0], np.cumsum(lengths)])
    sums = total[np.minimum(np.arange(n) + WINDOW, n)] - total[:n]
    largest = sums.max(initial=0)
    if not largest:
        return np.zeros(n, bool)
    surge = sums >= min(SURGE_MOST, SURGE_PART * largest)
    live = sums > 0
    run = np.cumsum(np.r_[True, live[1:] != live[:-1]]) - 1
    return live & np.isin(run, np.unique(run[surge & live]))


def main_text(page: str | None) -> str:
    """The article of one page, blocks joined by an empty line."""
    lines = lines_of(page) if page else []
    if any(text and inside for text, _, inside in lines):
        lines = [line if line[2] else ("", 0, False) for line in lines]
        # Inside an article every line of text counts, links too.
        lengths = np.array([len(text) for text, _, _ in lines], np.int64)
    else:
        lengths = np.array([free for _, free, _ in lines], np.int64)
        if not lengths.any():
            lengths = np.array([len(text) for text, _, _ in lines], np.int64)
    keep = kept_lines(lengths)
    return "\n\n".join(line[0] for line, k in zip(lines, keep) if k and line[0])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    def run(batches):
        for batch in batches:
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
