"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block of the page (paragraph, heading,
list item, table cell, text between breaks). A line's weight is the length of
its text; it is zero for page furniture: menus, headers and footers of the
page, sidebars, notices, adverts, forms, reader comments, or mostly link
text. Inside an <article> or <main> a line counts INSIDE times; where most
text lies in one, a line outside counts a quarter.

Block value i is the sum of the weights of WINDOW lines from i. Where it
surges past the threshold main text begins, where it dives to zero (WINDOW
lines without weight, or the border of an <article> or <main>) it ends; the
weighted lines of a stretch with a surge are kept. The threshold is the
largest block value on pages that never reach it.

Elements are furniture by their tag, role or a whole class name or id
(``site-footer`` is one, ``has-sidebar`` or ``main-menu-story`` are not).
Where nothing else surges past the threshold, the furniture element with the
most text is taken for a wrapper and its lines count again.

Character references are decoded after markup is gone. White space inside a
block becomes one space, blocks are joined by one space; nothing else is
dropped or cut.

Defined results: null or empty html, or a page without main text, gives an
empty text; elements left open end with the element around them; a tag that
another ``<`` interrupts is text; an unclosed comment or script runs to the
end of the page; equal block values all count; long pages take time in
proportion to their length; repeated rows are extracted each; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import column, prepare

WINDOW = 3
THRESHOLD = 86  # characters in a window of lines
LINK_SHARE = 0.6
INSIDE = 30  # weight of a line inside <article> or <main>: three characters pass the threshold

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|math|title|select|object)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^<>]*>",
    re.S | re.I,
)
_BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_FURNITURE = frozenset("nav aside footer form button head dialog menu fieldset".split())
# Names of furniture, and words that join with one into the name of a furniture element.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adslot adbox banner sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs comment comments commentlist disqus replies cookie cookies consent gdpr notice alert popup modal overlay newsletter "
    "subscribe subscription signup related recommended recommendations share sharing social widget widgets toolbar footer masthead skip-link "
    "pagination pager side-bar".split()
)
_JOINED = frozenset(
    "site page main top bottom left right primary secondary global header inner outer wrapper wrap container box bar block section area list "
    "items item links link buttons button posts articles content thread form policy slot unit panel group text message holder row rail".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


def _names_furniture(value: str) -> bool:
    """Whether one of the whole names in a class or id attribute is one of furniture."""
    for name in value.split():
        if name in _NAMES:
            return True
        parts = re.split("[-_]+", name)
        if len(parts) == 2 and any(p in _NAMES for p in parts) and all(p in _NAMES or p in _JOINED or p.isdigit() for p in parts):
            return True
    return False


def _is_furniture(tag: str, attrs: str, inside: bool) -> bool:
    if tag in _FURNITURE or (tag == "header" and not inside):
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in _ROLES):
            return True
        if name in ("class", "id") and _names_furniture(value):
            return True
    return False


def lines_of(html: str) -> list[tuple[str, tuple[int, ...], int, float]]:
    """(text, furniture elements around it, article or main around it or 0, share of link text) of each line of a page."""
    out, stack, text, linked = [], [], [], 0
    open_tags: Counter = Counter()
    off: tuple[int, ...] = ()  # numbers of the furniture elements that are open
    inside: list[int] = []
    link = elements = 0
    at = 0

    def flush():
        nonlocal linked
        line = " ".join(unescape("".join(text)).split())
        if line:
            out.append((line, off, inside[0] if inside else 0, min(1.0, linked / len(line))))
        text.clear()
        linked = 0

    def add(part: str):
        nonlocal linked
        if part:
            text.append(part)
            if link:
                linked += len(part.strip())

    def pop():
        nonlocal off, link
        tag, off, was_inside, was_link = stack.pop()
        open_tags[tag] -= 1
        link -= was_link
        if was_inside:
            inside.pop()

    for m in _TOKEN.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            flush()
        if m["close"]:
            if open_tags[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
        elif tag not in _VOID and not m["attrs"].endswith("/"):
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                pop()
            elements += 1
            stack.append((tag, off, tag in ("article", "main"), int(tag == "a")))
            open_tags[tag] += 1
            # inside furniture nothing else needs a look, so a line lies in one furniture element at most and its parents
            if not off and _is_furniture(tag, m["attrs"], bool(inside)):
                off = (elements,)
            if stack[-1][2]:
                inside.append(elements)
            link += stack[-1][3]
    add(html[at:])
    flush()
    return out


def _kept(lines: list, off: np.ndarray) -> tuple[list[str], bool]:
    """Lines of the stretches with a surge, and whether one passes the threshold."""
    length = np.array([len(line) for line, *_ in lines])
    inside = np.array([i for _, _, i, _ in lines])
    links = np.array([share > LINK_SHARE for *_, share in lines]) & (inside == 0)
    weight = np.where(off | links, 0, length * 4)
    marked = 2 * weight[inside > 0].sum() > weight.sum()
    weight = np.where(inside > 0, weight * INSIDE, weight // 4 if marked else weight)
    kept: list[tuple[int, int, int]] = []
    # stretches end at the borders of articles and at WINDOW lines without weight
    borders = np.flatnonzero(np.append(True, inside[1:] != inside[:-1]))
    for a, b in zip(borders, [*borders[1:], len(lines)]):
        total = np.concatenate([[0], np.cumsum(weight[a:b])])
        i = np.arange(b - a)
        value = total[np.minimum(i + WINDOW, b - a)] - total[i]
        dives = np.flatnonzero(value == 0)
        start = 0
        for end in [*dives.tolist(), b - a]:
            if end > start:
                kept.append((a + start, a + end, int(value[start:end].max())))
            start = end + 1
    best = max((v for *_, v in kept), default=0)
    limit = min(4 * THRESHOLD, best)
    texts = [lines[i][0] for x, y, v in kept if v >= limit > 0 for i in range(x, y) if weight[i] or (inside[i] and not off[i])]
    return texts, best >= 4 * THRESHOLD


def main_text(html: str | None) -> str:
    """The main text of a page."""
    lines = lines_of(html or "")
    if not lines:
        return ""
    furniture = np.array([f[0] if f else 0 for _, f, *_ in lines])
    texts, surged = _kept(lines, furniture > 0)
    if not surged and furniture.any():
        # nothing but furniture: the element with the most text is a wrapper
        sizes = np.bincount(furniture, [len(line) for line, *_ in lines])
        sizes[0] = 0
        if sizes.max() >= THRESHOLD:
            texts, _ = _kept(lines, (furniture > 0) & (furniture != sizes.argmax()))
    return " ".join(texts)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    prepare(pages.sparkSession)
    rows = pages.select(id_col, url_col, html_col)

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_col, url_col, "text", "n_chars"],
            )

    types = dict(rows.dtypes)
    return rows.mapInArrow(run, f"`{id_col}` {types[id_col]}, `{url_col}` {types[url_col]}, text string, n_chars long")
