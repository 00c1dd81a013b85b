"""Main text of HTML pages by a tree-structured graphical model.

A page is parsed into its tree of elements (unclosed paragraphs, list items and
cells end where HTML ends them; text cut off inside a tag or comment is markup).
Every element has a binary label, main text or not; its own features (tag, words
of its class, id and role, lengths, links, sentence marks) give its potential and
every parent and child share a potential. Sum-product messages go up the tree and
down again, which gives each element's exact marginal; the text of elements with
a marginal of one half or more is kept.

The weights are fitted by gradient ascent on the likelihood of the labelled pages
(``labelled_pages``, a bounded sample; the same inference gives the expected
counts). That takes seconds on the driver; pages are then independent of each
other, in one pass without a shuffle.

White space (also non-breaking) inside a block becomes one space, blocks are
joined in page order by one space, inline elements and removed comments don't
split words, ``br`` does. Never text: what stands in head, scripts, styles and
form controls.

Defined results: null or empty html, or a page without main text, gives "" and 0;
plain text without tags is its own main text; repeated rows are extracted alike.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections.abc import Iterable
from html import unescape
from math import exp, log, log1p

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime.llm.common import annotate, table
from pintime.llm.labelled_pages import PAGES, composed

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)"
                    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|$)|<(?=/?[a-zA-Z])[^>]*(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z]+")
_STOP = re.compile(r"[.!?;:]")

# fixed values of HTML
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
NEVER = RAW | {"head", "template", "select", "option", "button", "canvas", "audio", "video",
               "datalist"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "label",
          "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mfrac", "msup", "msub",
          "msubsup", "msqrt", "mroot", "mfenced", "mstyle", "mover", "munder", "tspan"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag of the first kind ends open elements of the second, not past the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}

#: Composed pages that the model is trained on, beside the written ones.
COMPOSED = 160
#: How much less likely than the field says a page without main text is taken to be.
EMPTY = 0.01

#: Words of class, id and role, by what they say of an element.
HINTS = {
    "advert": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs topbar toolbar pagination pager",
    "head": "header masthead logo branding",
    "foot": "footer copyright legal imprint colophon",
    "side": "sidebar aside widget related popular trending recommended complementary teaser",
    "notice": "cookie cookies notice consent gdpr alert popup modal overlay warning disclaimer",
    "talk": "comment comments reply replies discussion disqus respond responses reader",
    "share": "share sharing social follow subscribe newsletter signup login form search contact",
    "main": "article content post entry main story text body page",
}
_HINT = {w: h for h, words in HINTS.items() for w in words.split()}


class Node:
    __slots__ = ("tag", "attributes", "parent", "texts", "length", "links", "label", "rules")

    def __init__(self, tag: str, attributes: str, parent: int):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.texts: list[int] = []
        self.length = self.links = 0
        self.label, self.rules = 0, ()


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements in page order, and the text: (element, characters); -1 parts blocks.

    Where the open elements of each tag stand is kept, so no tag walks the stack: the work is
    linear in the page, however many elements are open or unclosed.
    """
    nodes = [Node("body", "", -1)]
    stack, pieces, at, hidden = [0], [], 0, 0
    places: dict[str, list[int]] = {}       # by tag, where it is open in the stack
    blocks = [0]                            # where elements that are not inline are
    low = None

    def text(end: int) -> None:
        if end > at and not hidden:
            part = html[at:end]
            pieces.append((stack[-1], unescape(part) if "&" in part else part))

    def push(tag: str, attributes: str) -> None:
        nodes.append(Node(tag, attributes, stack[-1]))
        places.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            blocks.append(len(stack))
        stack.append(len(nodes) - 1)

    def pop(upto: int) -> None:
        nonlocal hidden
        while len(stack) > upto:
            tag = nodes[stack.pop()].tag
            places[tag].pop()
            hidden -= tag in NEVER
            if tag not in INLINE:
                blocks.pop()
                pieces.append((-1, ""))

    def first_after(tags: Iterable[str], place: int) -> int:
        """The lowest open element of these tags above ``place``; the stack's end if none."""
        found = [p[i] for t in tags if (p := places.get(t))
                 and (i := bisect_right(p, place)) < len(p)]
        return min(found, default=len(stack))

    while (m := _TOKEN.search(html, at)) is not None:
        text(m.start())
        at = m.end()
        closing, tag = m[1], (m[2] or "").lower()
        if not tag or not m[4]:
            continue
        if closing:
            if places.get(tag):
                pop(places[tag][-1])
            continue
        if tag in ("html", "body"):
            nodes[0].attributes += m[3]
            continue
        if tag not in INLINE and tag not in VOID:
            # a block ends an open paragraph; items and cells end their like
            if tag in ENDS:
                ends, until = ENDS[tag]
                wall = max((p[-1] for t in until if (p := places.get(t))), default=0)
                pop(first_after(("p", *ends), wall))
            elif nodes[stack[blocks[-1]]].tag == "p":
                pop(blocks[-1])
            pieces.append((-1, ""))
        if tag in VOID:
            pieces.append((-1, ""))
            continue
        push(tag, m[3])
        hidden += tag in NEVER
        if tag in RAW:
            low = html.lower() if low is None else low
            end = low.find(f"</{tag}", at) if len(low) == len(html) else html.find(f"</{tag}", at)
            at = len(html) if end < 0 else end
        elif m[3].endswith("/") and tag in INLINE:
            pop(len(stack) - 1)
    text(len(html))
    return nodes, pieces


@functools.lru_cache(maxsize=100_000)
def _fixed(tag: str, attributes: str) -> tuple[str, ...]:
    """Features of the start tag."""
    out = [f"tag {tag}" if tag not in HEADINGS else "tag h"]
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes.lower()):
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                out += [f"hint {_HINT[w]}" for w in _WORD.findall(value) if w in _HINT]
            elif name == "hidden" or (name == "style" and "none" in value):
                out.append("hidden")
    return tuple(dict.fromkeys(out))


def features(nodes: list[Node], pieces: list[tuple[int, str]]) -> list[list[str]]:
    """Names of the features that hold for each element."""
    marked, sentence = [False] * len(nodes), [False] * len(nodes)
    for k, t in pieces:
        if k >= 0 and not t.isspace():
            marked[k] = marked[k] or "©" in t or "rights reserved" in t
            sentence[k] = sentence[k] or _STOP.search(t) is not None
            nodes[k].length += len(t.strip())
    linked = [0] * len(nodes)
    total = [n.length for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        n = nodes[k]
        linked[k] = total[k] if n.tag == "a" else linked[k]
        total[n.parent] += total[k]
        linked[n.parent] += linked[k]
    out = []
    for k, n in enumerate(nodes):
        names = ["any", *_fixed(n.tag, n.attributes)]
        size = n.length
        names.append("own none" if not size else "own word" if size < 25 else
                     "own line" if size < 100 else "own text")
        if marked[k]:
            names.append("copyright")
        if sentence[k]:
            names.append("sentence")
        if total[k] and 2 * linked[k] > total[k]:
            names.append("mostly links")
        out.append(names)
    return out


class Model:
    """Weights of the features (log odds of main text) and of parent-child pairs."""

    def __init__(self, weights: dict[str, float], pair: np.ndarray):
        self.weights, self.pair = weights, pair     # pair[parent label, child label], logs

    def messages(self, parents: list[int], odds: list[float]) -> tuple[list, list, list]:
        """Upward beliefs, messages to parents, and marginals' log odds."""
        (a, b), (c, d) = self.pair.tolist()

        def up(x: float) -> float:
            return _add(c, d + x) - _add(a, b + x)

        def down(x: float) -> float:
            return _add(b, d + x) - _add(a, c + x)

        belief, sent = list(odds), [0.0] * len(odds)
        for k in range(len(odds) - 1, 0, -1):      # children come after their parents
            sent[k] = up(belief[k])
            belief[parents[k]] += sent[k]
        full = list(belief)
        for k in range(1, len(odds)):
            full[k] = belief[k] + down(full[parents[k]] - sent[k])
        return belief, sent, full

    def empty(self, parents: list[int], belief: list[float]) -> float:
        """The probability that no element is main text, from the upward beliefs."""
        (a, b), _ = self.pair.tolist()
        whole = _add(0.0, belief[0])        # log of all labellings' weight over that of none
        for k in range(1, len(parents)):
            whole += _add(0.0, b - a + belief[k])
        return exp(-whole)

    def log_odds(self, nodes: list[Node], names: list[list[str]]) -> list[float]:
        weight = self.weights
        return [sum(weight.get(x, 0.0) for x in own) for own in names]

    def kept(self, nodes: list[Node], pieces: list[tuple[int, str]]) -> list[bool]:
        """Elements that are main text rather than not, given that a page has some: a labelling
        without any counts ``EMPTY`` times."""
        names, parents = features(nodes, pieces), [n.parent for n in nodes]
        belief, _, full = self.messages(parents, self.log_odds(nodes, names))
        least = 0.5 * (1 - (1 - EMPTY) * self.empty(parents, belief))
        return [1 / (1 + exp(-max(-500.0, min(500.0, x)))) >= least for x in full]


def _add(x: float, y: float) -> float:
    """log(exp(x) + exp(y))"""
    hi, lo = (x, y) if x > y else (y, x)
    return hi + log1p(exp(lo - hi))


def labelled(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """``parse`` of a page whose elements have labels."""
    nodes, pieces = parse(page)
    for k, n in enumerate(nodes):
        own = re.search(r"\by=([01])", n.attributes)
        n.label = int(own[1]) if own else nodes[n.parent].label if k else 0
    return nodes, pieces


def train(pages: list[str] | None = None, rounds: int = 100, rate: float = 0.3,
          decay: float = 0.01) -> Model:
    """Fit the weights to labelled pages by gradient ascent on their likelihood."""
    data = []
    for page in [*PAGES, *composed(COMPOSED, 1)] if pages is None else pages:
        nodes, pieces = labelled(page)
        data.append(([n.parent for n in nodes], features(nodes, pieces),
                     [n.label for n in nodes], nodes))
    weights: dict[str, float] = {x: 0.0 for _, names, _, _ in data for own in names for x in own}
    pair = np.zeros((2, 2))
    squares, pair_squares = {x: 1e-8 for x in weights}, np.full((2, 2), 1e-8)
    for _ in range(rounds):
        slope = {x: -decay * w for x, w in weights.items()}
        pair_slope = -decay * pair
        model = Model(weights, pair)
        for parents, names, labels, nodes in data:
            odds = model.log_odds(nodes, names)
            belief, sent, full = model.messages(parents, odds)
            for k, y in enumerate(labels):
                gap = y - 1 / (1 + exp(-max(-500.0, min(500.0, full[k]))))
                for x in names[k]:
                    slope[x] += gap
                if k:
                    p = parents[k]
                    rest = full[p] - sent[k]
                    joint = np.exp(pair - pair.max()) * np.exp(
                        np.array([[0.0, belief[k]], [rest, rest + belief[k]]])
                        - max(0.0, belief[k], rest, rest + belief[k]))
                    pair_slope -= joint / joint.sum()
                    pair_slope[labels[p], y] += 1
        for x, s in slope.items():      # steps scaled by past slopes
            squares[x] += s * s
            weights[x] += rate * s / squares[x] ** 0.5
        pair_squares += pair_slope ** 2
        pair = pair + rate * pair_slope / np.sqrt(pair_squares)
    return Model(weights, pair)


@functools.lru_cache(maxsize=1)
def trained() -> Model:
    return train()


def main_text(html: str, model: Model) -> str:
    if not html:
        return ""
    nodes, pieces = parse(html)
    keep = model.kept(nodes, pieces) if len(nodes) > 1 else [True]
    return joined(pieces, keep)


def joined(pieces: list[tuple[int, str]], keep: list[bool]) -> str:
    """The text of the kept elements, white space made single blanks."""
    return " ".join("".join(" " if k < 0 else t if keep[k] else " " for k, t in pieces).split())


def extract(pages: DataFrame, model: Model | None = None, html_col: str = "html") -> DataFrame:
    """``pages`` with the column _text: the main text of each page."""
    model = model or trained()
    return annotate(pages, html_col, "_text string",
                    lambda htmls: {"_text": [main_text(h, model) for h in htmls]})


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", F.col("_text").alias("text"),
                                 F.char_length("_text").cast("long").alias("n_chars"))
