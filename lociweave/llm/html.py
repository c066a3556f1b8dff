"""Main text of web pages by minimum cut.

A page becomes a row of text blocks. Each block's cost of being called
content or boilerplate comes from a logistic classifier over its words, links
and markup; these costs tie it to the two terminals. Blocks next to each other,
and blocks next to each other within one parent element, are tied by
smoothness edges that weaken with their distance in the element tree. The
minimum cut between the terminals is the labelling of least total cost.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape
from math import log1p
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm.common import sheltered

#: Element names of the HTML standard.
BLOCK_ELEMENTS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table"
    " tbody td tfoot th thead title tr ul".split()
)
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_ELEMENTS = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
SILENT_ELEMENTS = frozenset(
    "script style title head template noscript iframe object svg canvas audio video select textarea datalist"
    " xmp noembed noframes".split()
)
#: An opening tag of the first kind ends an open element of the second, up to one of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}

#: Weights of the classifier, in nats towards content.
BIAS = -0.6
ELEMENT_WEIGHTS = {
    "article": 3.0, "main": 2.0, "p": 0.8, "h1": 1.5, "h2": 0.5, "h3": 0.4, "blockquote": 0.8, "pre": 0.8, "td": 0.2, "figcaption": 0.3,
    "li": -0.2, "nav": -9.0, "footer": -9.0, "aside": -8.0, "form": -9.0, "header": -3.0, "menu": -8.0, "dialog": -8.0, "search": -9.0,
    "fieldset": -6.0, "address": -1.0, "label": -2.0,
}
GOOD_NAMES = re.compile(r"^(article|content|main|post|entry|story|body|text|prose)$")
BAD_NAMES = re.compile(
    r"^(ad|ads|adv|advert|adverts|advertisement|advertising|adsense|banner|sponsor|sponsored|promo|promoted|promotion|nav|navbar|navigation|menu|"
    r"breadcrumb|breadcrumbs|footer|masthead|topbar|sidebar|widget|cookie|cookies|consent|gdpr|popup|modal|"
    r"overlay|newsletter|subscribe|signup|login|sharing|comment|comments|respond|disqus|"
    r"pagination|pager|toolbar)$"
)
#: Words that name boilerplate or are what an article is about; they weigh as much as a few words' text can outweigh.
DOUBTFUL_NAMES = re.compile(
    r"^(notice|notices|alert|side|foot|header|legal|disclaimer|copyright|tags|hidden|search|skip|form|share|social|comm|reply|replies|related|"
    r"recommended|recommendations|trending)$"
)
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
GOOD_NAME, BAD_NAME, DOUBTFUL_NAME, HIDDEN = 1.5, -7.0, -3.0, -20.0
LINKED, LENGTH, STOPS = -4.0, 0.45, 0.5
#: Smoothness between neighbours, and between siblings, both divided by their distance in the tree.
NEXT, SIBLING = 1.5, 3.0

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|</?(?=[a-zA-Z])[^>]*$", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element(NamedTuple):
    name: str
    weight: float
    silent: bool
    linked: bool
    number: int
    parent: "Element | None"
    depth: int


class Block(NamedTuple):
    text: str
    cost: float
    element: Element


def _own_weight(name: str, attributes: str) -> float:
    """What an element's name, class, id and role tell of the blocks in it."""
    weight = ELEMENT_WEIGHTS.get(name, 0.0)
    if attributes.strip(" /\n\t\r"):
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), unescape(value.strip("\"'"))
            if key in ("class", "id"):
                names = {n.lower() for n in _NAME.findall(value)}
                if any(map(BAD_NAMES.match, names)):
                    weight += BAD_NAME
                elif any(map(DOUBTFUL_NAMES.match, names)):
                    # With other words in the name it tells less: what follows is of that kind, or about it.
                    weight += DOUBTFUL_NAME / len(names)
                elif any(map(GOOD_NAMES.match, names)):
                    weight += GOOD_NAME
            elif key == "role" and value.lower() in BAD_ROLES:
                weight += BAD_NAME
            elif key == "role" and value.lower() in ("main", "article"):
                weight += GOOD_NAME
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)
            ):
                weight += HIDDEN
    return weight


def blocks_of(html: str) -> list[Block]:
    """Text blocks of a page in order; white space inside each is one space."""
    root = Element("", BIAS, False, False, 0, None, 0)
    stack, blocks = [root], []
    text: list[str] = []
    chars = linked = number = 0

    def end_block() -> None:
        nonlocal chars, linked
        if text:
            whole = _SPACE.sub(" ", "".join(text)).strip()
            if whole:
                element = stack[-1]
                while element.name and element.name not in BLOCK_ELEMENTS:
                    element = element.parent
                words = whole.count(" ") + 1
                cost = element.weight + LINKED * min(1.0, linked / max(1, chars)) + LENGTH * log1p(words) - LENGTH * log1p(8)
                blocks.append(Block(whole, cost + (STOPS if whole[-1] in ".!?…:;\"”" else -STOPS), element))
        text.clear()
        chars = linked = 0

    def put(raw: str) -> None:
        nonlocal chars, linked
        element = stack[-1]
        if raw and not element.silent:
            plain = unescape(raw)
            text.append(plain)
            n = len(plain) - plain.count(" ")
            chars += n
            linked += n if element.linked else 0

    def close_to(index: int) -> None:
        if any(e.name in BLOCK_ELEMENTS for e in stack[index:]):
            end_block()
        del stack[index:]

    at, size = 0, len(html)
    while at < size:
        found = _TOKEN.search(html, at)
        if not found:
            put(html[at:])
            break
        put(html[at:found.start()])
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name:
            continue
        if found.group(1):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    close_to(i)
                    break
                # An inline end tag doesn't reach over a block.
                if name not in BLOCK_ELEMENTS and stack[i].name in BLOCK_ELEMENTS:
                    break
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCK_ELEMENTS:
            end_block()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    # A block ends an open paragraph, with what is open in it.
                    del stack[i:]
                    break
                if stack[i].name in BLOCK_ELEMENTS:
                    break
        if name in ENDS:
            ended, stop = ENDS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in stop:
                    break
                if stack[i].name in ended:
                    close_to(i)
                    break
        if name in VOID_ELEMENTS:
            continue
        up = stack[-1]
        number += 1
        silent = up.silent or name in SILENT_ELEMENTS
        weight = up.weight + (0.0 if silent else _own_weight(name, found.group(3) or ""))
        if name in RAW_ELEMENTS:
            # Up to its end tag everything is text of its own kind, which no block takes.
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if not (found.group(3) or "").rstrip().endswith("/") or name in BLOCK_ELEMENTS or name == "a":
            stack.append(Element(name, weight, silent, up.linked or name == "a", number, up, up.depth + 1))
    end_block()
    return blocks


def _apart(a: Element, b: Element) -> int:
    """Steps between two elements in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: true pays nothing where ``costs`` is positive, false where it is negative.

    A node with cost c pays |c| for the other label, an edge its weight if its
    ends differ. Found as the side of the source after a maximum flow along
    shortest augmenting paths by levels.
    """
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def tie(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to)), to.append(b), room.append(there)
        out[b].append(len(to)), to.append(a), room.append(back)

    for i, c in enumerate(costs):
        if c > 0:
            tie(source, i, c, 0.0)
        elif c < 0:
            tie(i, sink, -c, 0.0)
    for a, b, w in edges:
        tie(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                full = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while nxt[a] < len(out[a]):
                e = out[a][nxt[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                nxt[a] += 1
            if nxt[a] < len(out[a]):
                path.append(out[a][nxt[a]])
                a = to[path[-1]]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                nxt[a] += 1
            else:
                break


def labelled_blocks(html: str | None) -> list[tuple[str, bool]]:
    """Blocks of a page and whether each is content."""
    blocks = blocks_of(html) if html else []
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEXT / (1 + _apart(blocks[i - 1].element, b.element))))
        up = b.element.parent or b.element
        if (j := last.get(up.number)) is not None:
            edges.append((j, i, SIBLING / (1 + _apart(blocks[j].element, b.element))))
        last[up.number] = i
    labels = minimum_cut([b.cost for b in blocks], edges)
    return [(b.text, keep) for b, keep in zip(blocks, labels)]


def main_text(html: str | None) -> str:
    """Content blocks in page order, joined by line ends; empty for a null or empty page, or one without content."""
    return "\n".join(text for text, keep in labelled_blocks(html) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``row`` (all columns of ``pages``) and ``text``: the main text of each whole page, never null."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype="object")

    return sheltered(pages).withColumn("text", texts("row.html"))
