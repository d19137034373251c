"""Main-text extraction with a tree-structured graphical model.

A page's DOM is a tree of block nodes, each content or not. Node potentials
weigh a node's features, parent–child potentials connect a node with its
parent. Sum-product messages passed upward and then downward give the exact
marginal of every node; the text of nodes that are more likely content than not
is the page's text. The weights are trained from labelled pages by the
gradient of the exact log-likelihood, which the same messages provide: labels
are known for nodes with text of their own, the state of mere wrappers is
summed out. Inline elements named like adverts, comments or buttons are nodes
of their own on the line of their paragraph; closed form controls and fallbacks
are never content and no part of the tree.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.html_pages import LABELLED_PAGES

STEPS = 500
RATE = 2.0
PENALTY = 0.00005
#: Log potential that holds a node to its label.
HELD = 60.0

# Fixed values of HTML: elements without content, elements whose content is no
# markup, inline elements, and elements that end an open paragraph.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                  "param", "source", "track", "wbr"))
RAW = ("script", "style", "template", "textarea", "iframe", "title")
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "rt", "rp", "s", "samp", "small",
    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
    "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "msub",
    "msup", "msubsup", "munder", "mover", "munderover", "mtable", "mtr", "mtd", "semantics"))
ENDS_P = frozenset((
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div",
    "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
    "table", "ul", "dt", "dd"))
# Fixed values of HTML: controls and fallbacks, shown in the line or not at all.
CONTROLS = frozenset(("button", "select", "datalist", "noscript", "svg", "canvas", "audio",
                      "video"))
# Fixed values of HTML: an opening tag closes an open element of its group up to a boundary.
IMPLIED_END = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)),
               "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
               "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
               "option": (("option",), ("select",))}

#: Groups of tags, and of words in class, id and role, that share a weight.
TAGS = {
    "article": ("article", "main"), "section": ("section", "div", "body", "html", "center"),
    "text": ("p", "blockquote", "pre", "dd"), "heading": ("h1", "h2", "h3", "h4", "h5", "h6"),
    "list": ("ul", "ol", "dl", "menu", "dir"), "item": ("li", "dt"),
    "table": ("table", "tbody", "thead", "tr", "td", "th"), "nav": ("nav",),
    "header": ("header", "hgroup"), "footer": ("footer", "address"), "aside": ("aside", "dialog"),
    "form": ("form", "button", "fieldset", "legend", "optgroup", "option"),
    "figure": ("figure", "figcaption")}
WORDS = {
    "menu": ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination",
             "pager", "toc", "tabs"),
    "side": ("sidebar", "aside", "widget", "related", "recommended", "complementary", "rail",
             "trending", "popular", "tags", "tagcloud"),
    "advert": ("ad", "ads", "advert", "advertisement", "adsense", "banner", "sponsor",
               "sponsored", "promo", "promotion", "affiliate", "adbox", "dfp"),
    "notice": ("cookie", "cookies", "consent", "gdpr", "notice", "alert", "modal", "popup",
               "overlay", "newsletter", "subscribe", "signup", "paywall", "disclaimer"),
    "comment": ("comment", "comments", "commentlist", "reply", "replies", "respond",
                "discussion", "disqus", "reviews", "responses"),
    "foot": ("footer", "foot", "copyright", "legal", "colophon", "contentinfo", "bottom"),
    "head": ("header", "masthead", "topbar", "logo", "branding", "site", "search"),
    "social": ("share", "social", "sharing", "follow", "login", "toolbar", "meta", "byline"),
    "hidden": ("hidden", "invisible", "sr"),
    "main": ("article", "content", "post", "entry", "story", "main", "text", "articlebody",
             "body", "prose")}
FEATURES = ("bias", "root", *(f"tag {t}" for t in TAGS), "tag other",
            *(f"word {w}" for w in WORDS), "inside article", "no text", "short", "medium", "long",
            "links some", "links most", "sentence", "children with text", "inside other",
            "under no text", "under prose", "under much prose", "under links", "under heading",
            "copyright")
#: Tags and groups of words that say that what is inside is something else.
OTHER_TAGS = frozenset(("nav", "aside", "footer"))
OTHER_WORDS = frozenset(f"word {w}" for w in (
    "menu", "side", "advert", "notice", "comment", "foot", "social", "hidden"))
#: Characters from which a run of text that is no link is prose.
PROSE = 80
_TAG_OF = {tag: f"tag {group}" for group, tags in TAGS.items() for tag in tags}
_WORD_OF = {word: f"word {group}" for group, words in WORDS.items() for word in words}
_NUMBER = {name: i for i, name in enumerate(FEATURES)}

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_NAMED = re.compile(r"\b(?:class|id|role|itemprop|style|hidden|aria-hidden)\b", re.I)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


class Node:
    """A block element, or an inline one of its own: its runs of text by (line, place)."""

    __slots__ = ("tag", "words", "hidden", "label", "parent", "runs", "links", "inside", "never",
                 "other")

    def __init__(self, tag: str, attributes: dict[str, str], parent: int, inside: bool):
        named = " ".join(attributes.get(k, "") for k in ("class", "id", "role", "itemprop"))
        self.tag, self.parent, self.inside = tag, parent, inside
        self.words = set(_PARTS.findall(_CAMEL.sub(r"\1 \2", named).lower()))
        self.hidden = ("hidden" in attributes or attributes.get("aria-hidden") == "true"
                       or "display:none" in attributes.get("style", "").replace(" ", "").lower())
        self.label = attributes.get("data-content")
        self.runs: list[tuple[tuple[int, int], list[str]]] = []
        self.links = 0
        groups = {_WORD_OF[w] for w in self.words if w in _WORD_OF}
        self.other = (self.hidden or tag in OTHER_TAGS
                      or bool(groups & OTHER_WORDS) and "word main" not in groups)
        self.never = tag in ("option", "optgroup")


def parse_page(page: str) -> list[Node]:
    """Block nodes in page order (parents before children), from any sequence of tags.

    Unclosed and stray tags are repaired as browsers do: a block closes an open
    paragraph, list items and table cells close their kind, an end tag without
    its start is ignored. Inline elements belong to their block, but for those
    named like something else, which are nodes on its line.
    """
    nodes = [Node("html", {}, -1, False)]
    open_tags: list[tuple[str, int]] = [("html", 0)]  # open elements and their blocks
    run: list[str] | None = None  # text of the current node since the last tag of a node
    owner, line, places = 0, 0, 0
    links = 0
    at, end = 0, len(page)

    def add(text: str) -> None:
        nonlocal run, owner, places
        if run is None or owner != open_tags[-1][1]:
            run, owner, places = [], open_tags[-1][1], places + 1
            nodes[owner].runs.append(((line, places), run))
        run.append(text)
        if links:
            nodes[open_tags[-1][1]].links += len(text)

    def close(position: int) -> None:
        nonlocal run, line, links
        for tag, _ in open_tags[position:]:
            links -= tag == "a"
            if tag not in INLINE and tag not in CONTROLS:
                run, line = None, line + 1
        del open_tags[position:]

    while at < end:
        found = _MARKUP.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at:found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:  # an end tag
            for i in range(len(open_tags) - 1, 0, -1):
                if open_tags[i][0] == tag:
                    if tag in CONTROLS:
                        for node in nodes[open_tags[i][1]:]:
                            node.never = True
                    close(i)
                    break
            else:
                if tag == "br":
                    add(" ")
            continue
        if tag in RAW:
            if not found[3].rstrip().endswith("/"):
                closing = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if closing:
                    at = closing.end()
                elif tag != "template":  # whose content is markup
                    at = end
            continue
        if tag == "head":
            closing = re.compile(r"</head\s*>|<body\b", re.I).search(page, at)
            if closing:
                at = closing.start()
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in ("html", "body") or tag in VOID:
            if tag == "hr":
                run, line = None, line + 1
            label = re.search(r"data-content=(\d)", found[3]) if tag == "body" else None
            nodes[0].label = label[1] if label else nodes[0].label
            continue
        if tag in ENDS_P:
            for i in range(len(open_tags) - 1, 0, -1):
                if open_tags[i][0] == "p":
                    close(i)
                    break
                if open_tags[i][0] not in INLINE:
                    break
        if tag in IMPLIED_END:
            ends, boundary = IMPLIED_END[tag]
            for i in range(len(open_tags) - 1, 0, -1):
                if open_tags[i][0] in ends:
                    close(i)
                    break
                if open_tags[i][0] in boundary:
                    break
        block = open_tags[-1][1]
        links += tag == "a"
        if tag not in INLINE or _NAMED.search(found[3]):
            attributes = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "")
                          for m in _ATTRIBUTE.finditer(found[3])}
            parent = nodes[block]
            node = Node(tag, attributes, block, parent.inside or parent.tag in ("article", "main"))
            if tag not in INLINE or node.other:
                nodes.append(node)
                block = len(nodes) - 1
            if tag not in INLINE and tag not in CONTROLS:
                run, line = None, line + 1
        if not found[3].rstrip().endswith("/") or tag not in VOID:
            open_tags.append((tag, block))
    return nodes


def block_text(parts: list[str]) -> str:
    """A run's text: character references decoded, white space runs as one space, trimmed."""
    return " ".join(html.unescape("".join(parts)).split())


def node_features(nodes: list[Node]
                  ) -> tuple[np.ndarray, list[list[tuple[tuple[int, int], str]]]]:
    """A row of 0/1 features per node, and each node's runs as ``(place, text)``."""
    x = np.zeros((len(nodes), len(FEATURES)))
    x[:, 0] = 1.0
    runs = [[(place, block_text(parts)) for place, parts in n.runs] for n in nodes]
    sizes = [sum(len(t) for _, t in own) for own in runs]
    # characters, characters of links, runs of prose and headings in a node and below
    under = [[size, min(node.links, size),
              sum(len(t) >= PROSE for _, t in own) if node.links <= 0.3 * size else 0,
              int(node.tag in ("h1", "h2") and size > 0)]
             for node, own, size in zip(nodes, runs, sizes, strict=True)]
    for i in range(len(nodes) - 1, 0, -1):
        if not nodes[i].other and not nodes[i].never:
            up = under[nodes[i].parent]
            for k, value in enumerate(under[i]):
                up[k] += value
    inside = [False] * len(nodes)
    for i, node in enumerate(nodes):
        text = max((t for _, t in runs[i]), key=len, default="")
        size = sizes[i]
        names = ["root"] if i == 0 else [_TAG_OF.get(node.tag, "tag other")]
        names += {_WORD_OF[w] for w in node.words if w in _WORD_OF}
        if node.hidden:
            names.append("word hidden")
        if node.inside:
            names.append("inside article")
        if i:
            inside[i] = inside[node.parent] or nodes[node.parent].other
        if inside[i]:
            names.append("inside other")
        names.append("no text" if not size else "short" if size < 40
                     else "medium" if size < 160 else "long")
        if size and node.links > 0.2 * size:
            names.append("links most" if node.links > 0.6 * size else "links some")
        if text.endswith((".", "!", "?", ":", "…", "”", '"')):
            names.append("sentence")
        if "©" in text[:80] or text[:9].lower() == "copyright":
            names.append("copyright")
        whole, links, prose, headings = under[i]
        if not whole:
            names.append("under no text")
        if prose:
            names.append("under prose" if prose == 1 else "under much prose")
        if whole and links > 0.5 * whole:
            names.append("under links")
        if headings:
            names.append("under heading")
        for name in names:
            x[i, _NUMBER[name]] = 1.0
    for node, own in zip(nodes, runs, strict=True):
        if node.parent >= 0 and any(t for _, t in own):
            x[node.parent, _NUMBER["children with text"]] = 1.0
    return x, runs


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(scores: list[float], parents: list[int], pair: list[list[float]]
              ) -> tuple[list[float], list[tuple]]:
    """P(content) of each node, and of each (parent state, node state), by sum-product.

    ``scores``: log potential of content for each node (0 otherwise); ``pair``:
    2×2 log potentials by parent and child state. Messages go up from the last
    node to the first and then down, in one pass each, however deep the tree is.
    """
    n = len(parents)
    (p00, p01), (p10, p11) = pair
    up0, up1 = [0.0] * n, list(scores)  # own potential and the messages of all children
    sent = [(0.0, 0.0)] * n
    for i in range(n - 1, 0, -1):
        sent[i] = m0, m1 = (_log_sum(p00 + up0[i], p01 + up1[i]),
                            _log_sum(p10 + up0[i], p11 + up1[i]))
        up0[parents[i]] += m0
        up1[parents[i]] += m1
    down0, down1 = [0.0] * n, [0.0] * n
    joint = [(0.0, 0.0, 0.0, 0.0)] * n
    for i in range(1, n):
        parent = parents[i]
        out0 = up0[parent] - sent[i][0] + down0[parent]
        out1 = up1[parent] - sent[i][1] + down1[parent]
        joint[i] = (out0 + p00 + up0[i], out0 + p01 + up1[i],
                    out1 + p10 + up0[i], out1 + p11 + up1[i])
        down0[i] = _log_sum(out0 + p00, out1 + p10)
        down1[i] = _log_sum(out0 + p01, out1 + p11)
    odds = [up1[i] + down1[i] - up0[i] - down0[i] for i in range(n)]
    both = []
    for four in joint:
        top = max(four)
        parts = [math.exp(v - top) for v in four]
        both.append(tuple(v / sum(parts) for v in parts))
    return [1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, o)))) for o in odds], both


def labels_of(nodes: list[Node]) -> np.ndarray:
    """Labels of a labelled page: ``data-content`` of the nearest node that has one."""
    out = np.zeros(len(nodes))
    for i, node in enumerate(nodes):
        out[i] = (node.label == "1" if node.label is not None
                  else out[node.parent] if node.parent >= 0 else 0.0)
    return out


def tree_of(nodes: list[Node]) -> tuple[list[int], list[int]]:
    """The nodes of the model, without controls, and each one's parent among them."""
    kept = [i for i, n in enumerate(nodes) if not n.never]
    number = {i: k for k, i in enumerate(kept)}
    return kept, [number.get(nodes[i].parent, -1 if i == 0 else 0) for i in kept]


def _forest_marginals(scores: np.ndarray, parents: np.ndarray, levels: list[np.ndarray],
                      pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`marginals` for many trees at once, a depth at a time; ``both`` summed up."""
    up = np.stack([np.zeros_like(scores), scores])
    sent = np.zeros_like(up)
    for at in reversed(levels[1:]):
        sent[:, at] = np.logaddexp(pair[:, :1] + up[0, at], pair[:, 1:] + up[1, at])
        for state in (0, 1):
            np.add.at(up[state], parents[at], sent[state, at])
    down = np.zeros_like(up)
    both = np.zeros((2, 2))
    for at in levels[1:]:
        out = up[:, parents[at]] - sent[:, at] + down[:, parents[at]]
        down[:, at] = np.logaddexp(out[:1] + pair[0][:, None], out[1:] + pair[1][:, None])
        joint = out[:, None, :] + pair[:, :, None] + up[None, :, at]
        joint = np.exp(joint - joint.max(axis=(0, 1)))
        both += (joint / joint.sum(axis=(0, 1))).sum(axis=2)
    odds = up[1] + down[1] - up[0] - down[0]
    return 1.0 / (1.0 + np.exp(-np.clip(odds, -700, 700))), both


@lru_cache(maxsize=1)
def train(pages: tuple[str, ...] = LABELLED_PAGES, steps: int = STEPS) -> tuple:
    """``(weights, pair)`` by gradient ascent on the labelled pages' log-likelihood.

    The likelihood is that of the labels of nodes with text; the others are
    summed out, by messages in which the known labels are held.
    """
    rows, parents, depths, labels, known, size = [], [], [], [], [], 0
    for page in pages:
        nodes = parse_page(page)
        x, runs = node_features(nodes)
        kept, above = tree_of(nodes)
        depth: list[int] = []
        for p in above:
            depth.append(depth[p] + 1 if p >= 0 else 0)
        rows.append(x[kept])
        parents += [p + size if p >= 0 else -1 for p in above]
        depths += depth
        labels += labels_of(nodes)[kept].tolist()
        known += [any(t for _, t in runs[i]) for i in kept]
        size += len(kept)
    x, above, y, held = np.concatenate(rows), np.array(parents), np.array(labels), np.array(known)
    levels = [np.flatnonzero(np.array(depths) == d) for d in range(max(depths) + 1)]
    weights, pair = np.zeros(len(FEATURES)), np.array([[0.5, -0.5], [-0.5, 0.5]])
    speed_w, speed_p = np.zeros_like(weights), np.zeros_like(pair)
    force = np.where(held, np.where(y == 1, HELD, -HELD), 0.0)
    for _ in range(steps):
        scores = x @ weights
        p, both = _forest_marginals(scores, above, levels, pair)
        p_known, both_known = _forest_marginals(np.where(held, force, scores), above, levels, pair)
        speed_w = 0.9 * speed_w + x.T @ (p_known - p) / size - PENALTY * weights
        speed_p = 0.9 * speed_p + (both_known - both) / size - PENALTY * pair
        weights, pair = weights + RATE * speed_w, pair + RATE * speed_p
    return weights, pair.tolist()


def main_text(page: str | None, weights: np.ndarray, pair: list[list[float]]) -> str:
    """The text of a page's content blocks, in page order, joined by line feeds."""
    if not page or not page.strip():
        return ""
    nodes = parse_page(page)
    x, _ = node_features(nodes)
    kept, parents = tree_of(nodes)
    p, _ = marginals((x[kept] @ weights).tolist(), parents, pair)
    lines: dict[int, list[str]] = {}
    for (line, _), parts in sorted(run for i, odds in zip(kept, p, strict=True) if odds >= 0.5
                                   for run in nodes[i].runs):
        lines.setdefault(line, []).extend(parts)
    return "\n".join(text for parts in lines.values() if (text := block_text(parts)))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row: its main text and its code points.

    Null, empty and blank pages, and pages without main text, give an empty
    text; ids and urls may be null or repeated; extra columns are ignored; an
    empty table gives no rows. Whole pages are read, however long.
    """
    weights, pair = train()

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, weights, pair) for page in batch], dtype=object)

    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                         extract(F.col(html_col)).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
