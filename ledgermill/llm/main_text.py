"""Main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks: runs of text between block-level tags. A block is described by its number of
words and its share of linked words, the same of the blocks before and after it, and three facts about where it stands (in
a container that is page furniture or whose name only hints at it, in an article or main element, in a heading). A decision
tree grown from the labelled blocks below decides which blocks are main text. One pass over each page, no shuffle.

Furniture that holds the page's text is a wrapper and says nothing: outside an article element, if half of the page's
unlinked words are inside; without one, half are enough for a form or a hint, and nine tenths for a plain name. The header
of an article is part of it.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.tree import grow, predict

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Names that speak of what else a page has (has-sidebar, with-search, no-comments) say nothing of the element itself.
_ABOUT = re.compile(r"(?:^|[-_])(?:has|have|with|without|no|hide|show|is)[-_]")
_WORDS = re.compile(r"[a-z]+")

# Elements whose content is no text of the page.
_UNSEEN = {"script", "style", "template", "noscript", "iframe", "object", "svg", "canvas", "head", "title", "select",
           "textarea", "audio", "video"}
# Elements that do not end a block.
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
           "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
           "sub", "sup", "time", "tt", "u", "var", "wbr", "input",
           "math", "mi", "mn", "mo", "mtext", "mrow", "msub", "msup", "msubsup", "mfrac", "msqrt", "mroot", "semantics"}
# Elements without content.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Elements and names that mark page furniture.
_FURNITURE = {"nav", "footer", "header", "aside", "button", "menu", "dialog"}
_FORMS = {"form", "fieldset"}
_FURNITURE_NAMES = {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
                    "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "form", "header", "login",
                    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo",
                    "promotion", "related", "reply", "replies", "search", "share", "sharing", "sidebar", "social",
                    "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
# Words that a name of furniture has besides; with any other word the name is only a hint (social-science, share-story).
_PLAIN = {"area", "articles", "aside", "bar", "block", "bottom", "box", "button", "buttons", "col", "column", "container",
          "content", "global", "group", "icons", "info", "inner", "item", "items", "left", "link", "links", "list", "media",
          "message", "outer", "overlay", "page", "panel", "posts", "primary", "results", "right", "secondary", "section",
          "side", "site", "stories", "text", "thread", "title", "tools", "top", "unit", "wrap", "wrapper"}
# Names of what holds an article's text.
_TEXT_NAMES = ({"article", "entry", "post", "story"}, {"body", "content", "text"})
_ARTICLE = {"article", "main"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

#: Labelled blocks: words, share of linked words, the same of the block before and after, furniture (2; a hint 1), article,
#: heading; main.
LABELLED = [
    (6, 1.0, 0, 0.0, 5, 1.0, 2, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 2, 0, 0, 0), (1, 1.0, 1, 1.0, 12, 0.0, 2, 0, 0, 0),
    (9, 0.0, 1, 1.0, 11, 0.0, 2, 0, 0, 0), (14, 0.0, 2, 1.0, 40, 0.0, 2, 0, 0, 0), (8, 0.0, 60, 0.0, 0, 0.0, 2, 0, 0, 0),
    (12, 0.1, 90, 0.0, 0, 0.0, 2, 0, 0, 0), (35, 0.0, 80, 0.0, 20, 0.0, 2, 0, 0, 0), (50, 0.0, 30, 0.0, 45, 0.0, 2, 0, 0, 0),
    (24, 0.0, 18, 0.0, 60, 0.0, 2, 1, 0, 0), (7, 0.0, 50, 0.0, 22, 0.0, 2, 1, 0, 0), (3, 0.0, 9, 0.0, 2, 0.0, 2, 0, 1, 0),
    (11, 0.0, 14, 0.0, 90, 0.0, 0, 1, 1, 1), (6, 0.0, 9, 0.0, 30, 0.0, 0, 1, 1, 1), (3, 0.0, 70, 0.0, 44, 0.0, 0, 1, 1, 1),
    (90, 0.0, 11, 0.0, 130, 0.0, 0, 1, 0, 1), (130, 0.02, 90, 0.0, 70, 0.0, 0, 1, 0, 1),
    (2, 0.0, 130, 0.0, 41, 0.0, 0, 1, 0, 1), (1, 0.0, 55, 0.0, 8, 0.0, 0, 1, 0, 1), (41, 0.1, 2, 0.0, 9, 0.0, 0, 1, 0, 1),
    (20, 0.3, 60, 0.0, 33, 0.0, 0, 1, 0, 1), (4, 0.0, 3, 0.0, 5, 0.0, 0, 1, 0, 1), (8, 0.0, 20, 0.0, 3, 0.0, 0, 1, 0, 1),
    (6, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 4, 0.0, 2, 0.0, 0, 1, 0, 1), (2, 0.0, 9, 0.0, 4, 0.0, 0, 1, 0, 1),
    (5, 0.0, 0, 0.0, 3, 0.0, 0, 1, 0, 1), (10, 0.0, 2, 0.0, 1, 0.0, 0, 1, 0, 1), (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 1),
    (260, 0.0, 8, 0.0, 12, 0.0, 0, 1, 0, 1), (5, 1.0, 61, 0.0, 4, 1.0, 0, 1, 0, 0), (4, 1.0, 5, 1.0, 6, 1.0, 0, 1, 0, 0),
    (7, 0.9, 44, 0.0, 2, 1.0, 0, 1, 0, 0), (3, 1.0, 3, 1.0, 10, 0.0, 0, 0, 0, 0), (2, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
    (4, 0.8, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (6, 0.7, 40, 0.0, 5, 1.0, 0, 0, 0, 0), (30, 0.8, 6, 0.5, 25, 0.7, 0, 0, 0, 0),
    (3, 0.0, 4, 1.0, 2, 1.0, 0, 0, 0, 0), (5, 0.0, 3, 0.5, 6, 0.6, 0, 0, 0, 0), (2, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 0),
    (5, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0, 0), (4, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0, 0), (8, 0.0, 3, 1.0, 60, 0.0, 0, 0, 1, 1),
    (5, 0.0, 70, 0.0, 80, 0.0, 0, 0, 1, 1), (60, 0.0, 8, 0.0, 75, 0.0, 0, 0, 0, 1), (75, 0.05, 60, 0.0, 50, 0.0, 0, 0, 0, 1),
    (28, 0.0, 50, 0.0, 31, 0.0, 0, 0, 0, 1), (16, 0.1, 40, 0.0, 26, 0.0, 0, 0, 0, 1), (6, 0.0, 48, 0.0, 52, 0.0, 0, 0, 0, 1),
    (9, 0.0, 30, 0.0, 25, 0.0, 0, 0, 0, 1), (120, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (18, 0.0, 5, 0.0, 4, 0.0, 0, 0, 0, 1),
    (22, 0.0, 0, 0.0, 30, 0.0, 0, 0, 0, 1), (45, 0.2, 3, 1.0, 2, 1.0, 0, 0, 0, 1), (3, 0.0, 60, 0.0, 40, 0.0, 1, 0, 0, 0),
    (5, 0.4, 55, 0.0, 30, 0.0, 1, 1, 0, 0), (7, 0.0, 2, 1.0, 4, 1.0, 1, 0, 0, 0), (6, 0.0, 80, 0.0, 3, 1.0, 1, 1, 0, 0),
    (4, 1.0, 30, 0.0, 5, 1.0, 1, 0, 0, 0), (9, 0.9, 4, 1.0, 8, 1.0, 1, 0, 0, 0), (48, 0.0, 40, 0.0, 35, 0.0, 1, 0, 0, 1),
    (26, 0.0, 30, 0.0, 52, 0.0, 1, 0, 0, 1), (70, 0.05, 20, 0.0, 0, 0.0, 1, 1, 0, 1), (33, 0.0, 0, 0.0, 41, 0.0, 1, 0, 0, 1),
    (19, 0.0, 45, 0.0, 22, 0.0, 1, 1, 0, 1), (2, 0.0, 3, 1.0, 48, 0.0, 0, 0, 1, 1), (3, 0.0, 0, 0.0, 55, 0.0, 0, 0, 1, 1),
    (4, 0.0, 40, 0.0, 62, 0.0, 0, 0, 1, 1), (2, 0.0, 50, 0.0, 30, 0.0, 0, 0, 1, 1), (5, 0.0, 2, 1.0, 24, 0.0, 0, 0, 1, 1),
    (2, 0.0, 30, 0.0, 4, 1.0, 0, 0, 1, 0), (3, 0.0, 4, 1.0, 5, 1.0, 0, 0, 1, 0), (2, 0.0, 60, 0.0, 3, 0.9, 0, 0, 1, 0),
    (1, 0.0, 5, 1.0, 2, 1.0, 0, 0, 1, 0), (10, 0.0, 40, 0.0, 3, 1.0, 0, 1, 0, 1), (14, 0.0, 22, 0.0, 2, 1.0, 0, 1, 0, 1),
    (7, 0.0, 60, 0.0, 4, 1.0, 0, 1, 0, 1), (12, 0.0, 33, 0.0, 1, 1.0, 0, 0, 0, 1), (16, 0.1, 50, 0.0, 2, 1.0, 0, 0, 0, 1),
    (9, 0.0, 44, 0.0, 5, 1.0, 0, 1, 0, 1), (4, 0.0, 58, 0.0, 2, 1.0, 0, 1, 0, 1), (8, 0.0, 35, 0.0, 1, 1.0, 0, 0, 0, 1),
]


def _marks(tag: str, attributes: str) -> tuple[int, int, int]:
    """(furniture, article, heading) that an element brings to the text inside it; furniture is 2, a hint of it 1, and a
    header by its tag alone 3, as it may be an article's."""
    article, level = tag in _ARTICLE, 2 if tag in _FURNITURE - {"header"} else 0
    for found in _NAMES.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").lower().split():
            words = set(_WORDS.findall(_ABOUT.split(name)[0]))
            if tag in _FORMS:
                words.discard("form")
            if tag != "body" and ("main" in words or all(words & one for one in _TEXT_NAMES)):
                article = True
            if words & _FURNITURE_NAMES and tag not in ("html", "body", *_ARTICLE):
                level = max(level, 2 if words <= _FURNITURE_NAMES | _PLAIN else 1)
    if article and level == 1:
        level = 0
    if tag == "header" and level < 2:
        level = 3
    return level, int(article), int(tag in _HEADINGS)


def _end_of(tag: str) -> re.Pattern:
    """Where an element without text ends; a head ends with its body where it isn't closed."""
    if tag not in _ENDS:
        _ENDS[tag] = re.compile(f"</{re.escape(tag)}" + ("|<body" if tag == "head" else ""), re.I)
    return _ENDS[tag]


_ENDS: dict[str, re.Pattern] = {}


def text_blocks(html: str) -> list[tuple[str, int, int, tuple[int, int, int]]]:
    """(text, words, linked words, marks) of each block of text, in page order."""
    blocks, pieces = [], []  # pieces: (text, is it linked)
    stack: list[tuple[str, tuple[int, int, int], int]] = []  # tag, marks, number of a form or of furniture
    plain, total, forms = {}, 0, 0  # unlinked words of each numbered element, and of the page
    at, links = 0, 0

    def add(raw: str) -> None:
        if raw:
            pieces.append((unescape(raw) if "&" in raw else raw, links > 0))

    def close() -> None:
        if pieces:
            text = " ".join("".join(p for p, _ in pieces).split())
            if text:
                nonlocal total
                words = len(text.split())
                linked = min(words, sum(len(p.split()) for p, is_link in pieces if is_link))
                inner = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][1][1]), -1)
                furniture = []  # (number, level, share of the page's words from which it is a wrapper)
                for i, (tag, m, form) in enumerate(stack):
                    if form and not (m[0] == 3 and 0 <= inner < i):
                        share = 0.9 if m[0] >= 2 and inner < 0 and tag not in _FORMS else 0.5
                        share = 2.0 if 0 <= inner < i and tag not in _FORMS else share  # never a wrapper
                        furniture.append((form, min(m[0], 2) or 2, share))
                total += words - linked
                for _, _, form in stack:
                    if form:
                        plain[form] = plain.get(form, 0) + words - linked
                there = tuple(max((m[i] for _, m, _ in stack), default=0) for i in (1, 2))
                blocks.append((text, words, linked, there, furniture))
            pieces.clear()

    while True:
        found = _TOKEN.search(html, at)
        if found is None:
            add(html[at:])
            break
        add(html[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(found[1] or found[4]), found[3] or found[6] or ""
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag in _UNSEEN:
            if not closing and not attributes.endswith("/"):
                end = _end_of(tag).search(html, at)
                at = end.start() if end else at if tag == "head" else len(html)
            continue
        if tag in _INLINE:
            if tag == "br":
                pieces.append((" ", False))
            continue
        close()
        if tag in _VOID:
            continue
        if not closing:
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):  # may be left open; the next one closes it
                if stack and stack[-1][0] == tag:
                    stack.pop()
            if not attributes.endswith("/"):
                marks = _marks(tag, attributes)
                numbered = tag in _FORMS or marks[0]
                forms += bool(numbered)
                stack.append((tag, marks, forms if numbered else 0))
        elif any(name == tag for name, *_ in stack):
            while stack.pop()[0] != tag:
                pass
        links = 0 if tag in ("body", "nav", "ul", "article", "footer") else links
    close()

    def level(furniture: list) -> int:
        return max((lv for form, lv, share in furniture if plain[form] < share * total or not total), default=0)

    return [(text, words, linked, (level(furniture), *there)) for text, words, linked, there, furniture in blocks]


def features(blocks: list) -> np.ndarray:
    """The described columns of ``LABELLED``, one row per block."""
    own = np.array([(words, linked / words) for _, words, linked, _ in blocks], float).reshape(-1, 2)
    none = np.zeros((1, 2))
    marks = np.array([m for *_, m in blocks], float).reshape(-1, 3)
    return np.hstack([own, np.vstack([none, own])[:-1], np.vstack([own, none])[1:], marks])


def trained_tree():
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1], depth=7)


def main_text(html: str | None, tree) -> str:
    blocks = text_blocks(html or "")
    if not blocks:
        return ""
    keep = predict(tree, features(blocks)) >= 0.5
    return "\n".join(b[0] for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per page. A null page is empty; a page without main text gives an empty text. Keys and
    urls are passed through, null or repeated; other columns are not read."""
    tree = trained_tree()

    def run(batches):
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                texts = [main_text(x.as_py(), tree) for x in part.column(2)]
                counts = [len(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
