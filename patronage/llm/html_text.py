"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut at block tags into flat blocks of text. Each block has its number of words and its
link density (share of its letters inside links), the same of the blocks before and after it, and
whether it lies in a part of the page named as something else (menu, form, comments ...) or named
as the article. A decision tree trained on `EXAMPLES`, a small labelled table, tells article
blocks from the rest.

A null page is empty. If no block of a page is article text, all that are in no part named otherwise
and are not mostly links are: a page of a heading and a sentence is short, not empty. What is left
without such blocks has an empty text. Markup may be cut off or
badly nested: a start tag closes what HTML lets end without a tag, an end tag closes what is open inside it, an end tag without a start does nothing,
and an unended comment or script reaches to the end.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)(?:\s(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)?(?<=/)>"
    r"|<(script|style|template|textarea|title|svg|math|iframe)\b[^>]*+>"
    r".*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*+>"
    r"""|<(/?)([a-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(/?)([a-z][^\s/>]*+)([^>]*+)>",
    re.S | re.I,
)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OTHER = frozenset("nav aside form footer head menu dialog fieldset search".split())
#: Elements whose text is no text of the page; unended ones end with their parent.
_SILENT = frozenset("noscript select button object canvas audio video".split())
_INSIDE = frozenset("article main".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
_NAMED = re.compile(
    r"(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary|header|footer|post|article|user|reader)[-_]?)?"
    r"(?:ads?|adv|advert\w*|adsense|banner\w*|sponsor\w*|promo\w*|sidebars?|side-?bar|widgets?|menus?|nav|navbar|navigation|"
    r"breadcrumbs?|toolbar|footer|comments?|respond|replies|disqus\w*|share|sharing|social|related|"
    r"recommend\w*|newsletter|subscribe\w*|subscription|signup|login|search|cookies?|consent|gdpr|notices?|alerts?|"
    r"popup|modal|overlay|pagination|pager|paywall|skip|masthead|copyright)"
    r"(?:[-_]?(?:box|bar|banner|notice|container|wrapper|wrap|list|area|section|inner|block|form|links?|item|menu|message|popup|consent|unit|slot|top|bottom|left|right|thread|\d+))*",
    re.I,
)
#: Names that mean something else around an article, and may mean a part of it inside.
_AROUND = re.compile(
    r"(?:(?:site|page|main|top|global)[-_]?)?(?:header|legal|discussions?)(?:[-_]?(?:bar|box|area|section|inner|wrap|wrapper|container|links?|thread))*",
    re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
#: Start tags that end an open p.
_ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
_ITEM_LIMITS = _BLOCK - frozenset("address div p".split())
_ROWS = frozenset("caption colgroup tr".split())
_CELLS = frozenset("td th".split())
_GROUPS = _ROWS | frozenset("tbody tfoot thead".split())
_TABLE = frozenset(["table"])
#: By start tag: the open elements that it ends, and those beyond which it ends nothing.
_IMPLIED = {
    "li": (frozenset(["li"]), _ITEM_LIMITS - {"li"}),
    **dict.fromkeys(("dt", "dd"), (frozenset(["dt", "dd"]), _ITEM_LIMITS - {"dt", "dd"})),
    "option": (frozenset(["option"]), _BLOCK - {"option"}),
    "optgroup": (frozenset(["option", "optgroup"]), _BLOCK - {"option", "optgroup"}),
    **dict.fromkeys(("td", "th"), (_CELLS, _TABLE | {"tr"})),
    "tr": (_ROWS, _TABLE),
    **dict.fromkeys(("tbody", "tfoot", "thead", "caption", "colgroup"), (_GROUPS, _TABLE)),
}
_P = (frozenset(["p"]), frozenset("table td th caption".split()))
_HEAD = (frozenset(["head"]), frozenset(["body"]))
_IN_HEAD = frozenset("base basefont bgsound html link meta".split())
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    words: int
    links: float
    other: bool
    inside: bool


def _part(tag: str, attributes: str, inside: int) -> tuple[bool, bool]:
    """Whether an element is named as something else, and whether as the article."""
    if tag in ("html", "body"):
        return False, False
    if tag == "header":
        return not inside, False
    other, article = tag in _OTHER, tag in _INSIDE
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = next((v for v in values if v), "")
            name = name.lower()
            if name == "hidden" or name == "style" and _UNSEEN.search(value) or name == "aria-hidden" and value.strip().lower() == "true":
                return True, False
            if name == "role":
                other |= value.lower() in _ROLES
                article |= value.lower() in ("main", "article")
            elif name in ("class", "id") and not article:
                for part in value.split():
                    other |= bool(_NAMED.fullmatch(part)) or not inside and bool(_AROUND.fullmatch(part))
            elif name == "itemprop":
                article |= value.lower() == "articlebody"
    return other, article


def blocks(page: str | None) -> list[Block]:
    """Flat text blocks of a page in order, empty ones left out."""
    found: list[Block] = []
    text: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool]] = []
    other = inside = links = silent = 0

    def flush():
        nonlocal linked
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                letters = len(whole) - whole.count(" ")
                found.append(Block(whole, whole.count(" ") + 1, min(1.0, linked / max(1, letters)), other > 0, inside > 0))
            text.clear()
        linked = 0

    def add(piece: str):
        nonlocal linked
        if silent:
            text.append(" ")
            return
        text.append(piece)
        if links:
            linked += len("".join(html.unescape(piece).split()))

    def pop():
        nonlocal other, inside, links, silent
        name, was_other, was_inside = stack.pop()
        other -= was_other
        inside -= was_inside
        links -= name == "a"
        silent -= name in _SILENT
        return name

    def end(names: frozenset, limits: frozenset):
        """Close the outermost open element of some names below the nearest of the limits."""
        last = None
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                last = k
            elif stack[k][0] in limits:
                break
        while last is not None and len(stack) > last:
            pop()

    page = page or ""
    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        closing, tag, attributes = token.group(2, 3, 4) if token.group(3) else token.group(5, 6, 7)
        if not tag:
            if token.group(1):
                text.append(" ")
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            flush()
        elif tag in ("br", "img"):
            text.append(" ")
        if closing:
            if any(open_tag == tag for open_tag, _, _ in stack):
                while stack and pop() != tag:
                    pass
            continue
        if tag not in _IN_HEAD and tag != "head":
            end(*_HEAD)
        if tag in _IMPLIED:
            end(*_IMPLIED[tag])
        if tag in _ENDS_P:
            end(*_P)
        if tag not in _VOID and not attributes.endswith("/"):
            is_other, is_inside = _part(tag, attributes, inside)
            stack.append((tag, is_other, is_inside))
            other += is_other
            inside += is_inside
            links += tag == "a"
            silent += tag in _SILENT
    if at < len(page):
        add(page[at:])
    flush()
    return found


def features(found: list[Block]) -> np.ndarray:
    """A row per block: see `COLUMNS`."""
    own = np.array([[b.words, b.links, b.other, b.inside] for b in found], float).reshape(-1, 4)
    edge = np.zeros((1, 2))
    before = np.concatenate([edge, own[:-1, :2]])[: len(own)]
    after = np.concatenate([own[1:, :2], edge])[: len(own)]
    return np.concatenate([own[:, :2], before, after, own[:, 2:]], axis=1)


COLUMNS = ("words", "links", "words_before", "links_before", "words_after", "links_after", "other", "inside")
#: Labelled blocks: the columns above, then 1 for article text.
EXAMPLES = np.array(
    [
        # menus, footers, adverts, forms and comments, named as such
        [1, 1, 0, 0, 1, 1, 1, 0, 0], [2, 1, 1, 1, 3, 1, 1, 0, 0], [6, 0, 1, 1, 12, 0, 1, 0, 0], [30, 0, 6, 0, 80, 0, 1, 0, 0],
        [9, 0.2, 60, 0, 0, 0, 1, 0, 0], [4, 0, 40, 0, 50, 0, 1, 1, 0], [45, 0, 70, 0, 60, 0, 1, 1, 0], [90, 0.1, 50, 0, 20, 0, 1, 1, 0],
        [12, 0.5, 100, 0, 0, 0, 1, 1, 0], [25, 0, 3, 0, 25, 0, 1, 0, 0], [60, 0, 2, 0, 70, 0, 1, 0, 0], [1, 0, 1, 0, 1, 0, 1, 1, 0],
        [150, 0, 9, 0, 0, 0, 1, 0, 0], [7, 1, 7, 1, 7, 1, 1, 1, 0], [3, 0, 200, 0, 90, 0, 1, 1, 0], [18, 0, 0, 0, 0, 0, 1, 0, 0],
        # blocks of an article named as such: headings, long and short paragraphs, lists of links
        [7, 0, 1, 1, 40, 0, 0, 1, 1], [80, 0, 7, 0, 60, 0, 0, 1, 1], [1, 0, 80, 0, 90, 0, 0, 1, 1], [3, 0, 0, 0, 0, 0, 0, 1, 1],
        [12, 0.3, 50, 0, 45, 0, 0, 1, 1], [5, 1, 30, 0, 5, 1, 0, 1, 1], [2, 1, 2, 1, 70, 0, 0, 1, 1], [240, 0.05, 3, 0, 1, 0, 0, 1, 1],
        [1, 0, 6, 1, 1, 0, 0, 1, 1], [25, 0, 4, 1, 9, 0.2, 0, 1, 1], [60, 0.6, 60, 0, 60, 0, 0, 1, 1], [4, 0, 2, 0, 9, 0.2, 0, 1, 1],
        # unnamed parts: running text
        [60, 0, 6, 0, 70, 0, 0, 0, 1], [45, 0.1, 60, 0, 30, 0, 0, 0, 1], [110, 0.05, 2, 1, 1, 1, 0, 0, 1], [25, 0, 40, 0, 50, 0, 0, 0, 1],
        [18, 0, 25, 0.1, 33, 0, 0, 0, 1], [16, 0.1, 1, 1, 45, 0, 0, 0, 1], [13, 0, 3, 0, 0, 0, 0, 0, 1], [35, 0.2, 0, 0, 4, 1, 0, 0, 1],
        # unnamed parts: headings and short paragraphs next to running text
        [6, 0, 3, 1, 60, 0, 0, 0, 1], [4, 0, 50, 0, 45, 0, 0, 0, 1], [2, 0, 30, 0, 35, 0.1, 0, 0, 1], [8, 0, 4, 0, 28, 0, 0, 0, 1],
        [5, 0, 55, 0, 2, 1, 0, 0, 1], [9, 0.1, 25, 0, 3, 0, 0, 0, 1],
        # unnamed parts: links, short notes far from running text
        [2, 1, 2, 1, 3, 1, 0, 0, 0], [8, 0.9, 2, 1, 7, 1, 0, 0, 0], [20, 0.8, 12, 0.7, 15, 0.9, 0, 0, 0], [6, 0.6, 40, 0, 3, 1, 0, 0, 0],
        [3, 0, 2, 1, 4, 1, 0, 0, 0], [4, 0, 1, 0, 2, 0, 0, 0, 0], [7, 0, 3, 1, 5, 0, 0, 0, 0], [30, 0.7, 60, 0, 9, 1, 0, 0, 0],
        [5, 0.2, 2, 0.5, 1, 1, 0, 0, 0], [1, 0, 0, 0, 2, 1, 0, 0, 0], [9, 0.8, 70, 0, 50, 0, 0, 0, 0], [2, 0, 4, 0, 3, 0.5, 0, 0, 0],
        # unnamed parts: more of both
        [40, 0, 0, 0, 0, 0, 0, 0, 1], [70, 0, 1, 1, 0, 0, 0, 0, 1], [20, 0, 8, 0, 5, 0, 0, 0, 1], [15, 0.1, 20, 0.9, 60, 0, 0, 0, 1],
        [55, 0, 5, 1, 8, 1, 0, 0, 1], [3, 0, 60, 0, 70, 0, 0, 0, 1], [7, 0, 22, 0, 90, 0, 0, 0, 1], [10, 0.1, 34, 0, 41, 0, 0, 0, 1],
        [3, 1, 50, 0, 60, 0, 0, 0, 0], [12, 1, 3, 1, 30, 0, 0, 0, 0], [1, 1, 90, 0, 1, 1, 0, 0, 0], [6, 0, 1, 1, 2, 1, 0, 0, 0],
        [3, 0, 5, 0, 2, 0, 0, 0, 0], [8, 0, 0, 0, 1, 1, 0, 0, 0], [22, 0.9, 45, 0, 50, 0, 0, 0, 0], [5, 0, 6, 0.8, 6, 0, 0, 0, 0],
    ]
)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 5, least: int = 3) -> tuple | float:
    """A binary tree (column, limit, tree at most, tree over) by least Gini impurity; leaves: share of 1."""
    labels = labels.reshape(-1)
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = (share * (1 - share) * len(labels) - 1e-9, None, None)
    for column in range(rows.shape[1] - 1, -1, -1):
        values = np.unique(rows[:, column])
        for limit in (values[1:] + values[:-1]) / 2:
            left = rows[:, column] <= limit
            if min(left.sum(), (~left).sum()) < least:
                continue
            impurity = sum(len(y) * y.mean() * (1 - y.mean()) for y in (labels[left], labels[~left]))
            if impurity < best[0]:
                best = (impurity, column, limit)
    if best[1] is None:
        return share
    left = rows[:, best[1]] <= best[2]
    return best[1], best[2], grow(rows[left], labels[left], depth - 1), grow(rows[~left], labels[~left], depth - 1)


def decide(tree: tuple | float, row) -> float:
    while isinstance(tree, tuple):
        column, limit, low, high = tree
        tree = low if row[column] <= limit else high
    return tree


#: What stands before and after a block means the same, so each example also counts mirrored.
_mirrored = EXAMPLES[:, [0, 1, 4, 5, 2, 3, 6, 7, 8]]
TREE = grow(*np.split(np.concatenate([EXAMPLES, _mirrored]), [8], axis=1))


def main_text(page: str | None) -> str:
    found = blocks(page)
    kept = [b for b, row in zip(found, features(found).tolist()) if decide(TREE, row) > 0.5]
    kept = kept or [b for b in found if not b.other and b.links < 0.5]
    return "\n\n".join(b.text for b in kept)


def extract(pages: DataFrame, name: str = "text") -> DataFrame:
    """`pages` with the main text of each whole `html`, in place of that column."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[name] = [main_text(p) for p in pdf.pop("html")]
            yield pdf

    rest = pages.drop(name) if name != "html" else pages
    fields = [f for f in rest.schema.fields if f.name != "html"]
    return rest.mapInPandas(texts, T.StructType([*fields, T.StructField(name, T.StringType())]))
