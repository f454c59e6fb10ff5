"""HTML extraction with a tree-structured graphical model.

A page becomes a tree of its block elements. Each node is content or not; a node's own
look gives it a potential, and so does each pair of a parent and a child. Messages pass
from the leaves up and from the root down (sum-product), which on a tree gives exact
marginals. Text is kept where its node's marginal says content. The weights are learned
from labelled pages by following the gradient of the likelihood, which the same messages
give.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col, cols
from .frames import hidden
from .labelled_pages import labelled_pages

# Elements by what they do (fixed values of the HTML standard).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong "
    "sub sup time tt u var wbr br img picture source data".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed xmp template".split())
HIDDEN = frozenset("script style noscript iframe noembed template head title meta link svg canvas object".split())
# Opening one of these ends an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)
# Opening a key ends these, up to the element that holds them.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

# A tag with an unclosed quote ends at its first ">".
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")

# Parts of class and id names, by what they hint at.
HINTS = {
    "good": ("article", "content", "main", "body", "post", "entry", "story", "text"),
    "menu": ("nav", "menu", "crumb", "tabs", "toolbar", "pagination", "pager", "skip"),
    "frame": ("header", "masthead", "banner", "footer", "foot", "copyright", "legal"),
    "side": ("side", "aside", "widget", "related", "recommend", "trending", "popular", "more", "tags"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "outbrain"),
    "notice": ("cookie", "consent", "notice", "popup", "modal", "gdpr", "alert", "overlay", "newsletter", "subscribe"),
    "talk": ("comment", "comments", "reply", "replies", "disqus", "discussion", "respond"),
    "form": ("form", "login", "signup", "search", "share", "social"),
}
TAGS = (
    "article main section div p h1 h2 h3 h4 h5 h6 ul ol li nav header footer aside form table tr td blockquote pre "
    "figure figcaption dl dt dd body html address button select label fieldset details dialog"
).split()
_TAG = {t: i for i, t in enumerate(TAGS)}
_HINT = {h: len(TAGS) + i for i, h in enumerate(HINTS)}
# Own text: none, short, long, much of it links, with sentences; depth; constant.
_OWN = len(TAGS) + len(HINTS)
N_FEATURES = _OWN + 8
N_PAIRS = 4 + 2 * len(TAGS)


class Node:
    __slots__ = ("tag", "names", "parent", "texts", "linked", "size")

    def __init__(self, tag: str, names: str, parent: int):
        self.tag, self.names, self.parent = tag, names, parent
        self.texts: list[tuple[int, str]] = []
        self.linked = 0
        self.size = 0


def parse(page: str | None) -> list[Node]:
    """Block elements in page order, the root first. Text belongs to the innermost block
    around it, with its place in the page; hidden elements and comments have none.
    Broken markup is read as it comes: what is not closed ends with its parent."""
    nodes = [Node("html", "", -1), Node("body", "", 0)]
    # Open elements and their blocks; the first two are there in every page.
    stack: list[tuple[str, int]] = [("html", 0), ("body", 1)]
    page, at, place = page or "", 0, 0
    links = 0

    def text(raw: str) -> None:
        nonlocal place
        if raw:
            node = nodes[stack[-1][1]]
            words = entities.unescape(raw) if "&" in raw else raw
            node.texts.append((place, words))
            node.size += len(words)
            if links:
                node.linked += len(words)
            place += 1

    def close(to: int) -> None:
        nonlocal links
        for tag, _ in stack[to:]:
            links -= tag == "a"
        del stack[to:]

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            rest = page[at:]
            # A tag that the page's end cuts off is no text.
            cut = re.search(r"<[a-zA-Z/!?][^<]*\Z", rest)
            text(rest[: cut.start()] if cut else rest)
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in ("html", "body"):
            continue
        if m[1]:
            for i in range(len(stack) - 1, 1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                # An inline end tag does not close blocks.
                if tag in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if tag in HIDDEN or tag in RAW:
            if tag in RAW:
                end = re.compile(r"</" + re.escape(tag) + r"[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if tag not in ("head", "svg", "canvas", "object"):
                continue
            end = re.compile(r"</" + tag + r"\s*>|<body\b" if tag == "head" else r"</" + tag + r"\s*>", re.I).search(page, at)
            if end:
                at = end.start() if end[0].lower().startswith("<body") else end.end()
            continue
        if tag == "br" or tag == "hr":
            text(" ")
            if tag == "br":
                continue
        if tag in VOID:
            continue
        if tag in INLINE:
            links += tag == "a"
            stack.append((tag, stack[-1][1]))
            continue
        if tag in ENDS_PARAGRAPH:
            for i in range(len(stack) - 1, 1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] not in INLINE:
                    break
        if tag in SIBLINGS:
            ended, holders = SIBLINGS[tag]
            for i in range(len(stack) - 1, 1, -1):
                if stack[i][0] in holders:
                    break
                if stack[i][0] in ended:
                    close(i)
                    break
        names = " ".join("".join(g for g in found if g) for found in _NAMES.findall(m[3])).lower()
        nodes.append(Node(tag, names, stack[-1][1]))
        if not m[3].endswith("/"):
            stack.append((tag, len(nodes) - 1))
    return nodes


def features(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature rows, parent of each node, depth of each node)."""
    x = np.zeros((len(nodes), N_FEATURES), np.float32)
    parents = np.array([n.parent for n in nodes])
    depth = np.zeros(len(nodes), np.int64)
    for i, node in enumerate(nodes):
        if i:
            depth[i] = depth[node.parent] + 1
        if node.tag in _TAG:
            x[i, _TAG[node.tag]] = 1.0
        words = set(re.findall(r"[a-z]+", node.names)) if node.names else ()
        for hint, parts in HINTS.items():
            if words and any(p in words for p in parts):
                x[i, _HINT[hint]] = 1.0
        own = x[i, _OWN:]
        size = node.size
        own[0] = size == 0
        own[1] = 0 < size < 40
        own[2] = size >= 120
        own[3] = size > 0 and node.linked > 0.5 * size
        body = "".join(t for _, t in node.texts) if size else ""
        own[4] = any(mark in body for mark in (". ", ", ", "! ", "? ")) or body.rstrip()[-1:] in (".", "!", "?")
        own[5] = "©" in body or "copyright" in body.lower()
        own[6] = depth[i] <= 1
        own[7] = 1.0
    return x, parents, depth


def pair_features(nodes: list[Node]) -> np.ndarray:
    """For each node, the pair with its parent: which tags meet."""
    out = np.zeros((len(nodes), 2 * len(TAGS) + 2), np.float32)
    for i, node in enumerate(nodes):
        if node.parent >= 0:
            if node.tag in _TAG:
                out[i, _TAG[node.tag]] = 1.0
            if nodes[node.parent].tag in _TAG:
                out[i, len(TAGS) + _TAG[nodes[node.parent].tag]] = 1.0
            out[i, -2] = nodes[node.parent].parent < 0
            out[i, -1] = 1.0
    return out


class Model:
    """Potentials: ``node`` scores content; ``pair`` scores, per pair feature, the four
    states (parent, child) of which (0, 0) is the reference."""

    def __init__(self, node: np.ndarray, pair: np.ndarray):
        self.node, self.pair = node, pair

    def marginals(self, x, pairs, parents, depth):
        """(content marginal of each node, joint marginals with its parent, log Z).

        Nodes of many pages may come together; those at one depth are dealt with at
        once, deepest first upward and then back down.
        """
        n = len(x)
        unary = np.zeros((n, 2))
        unary[:, 1] = x @ self.node
        edge = np.zeros((n, 2, 2))
        edge[:, 0, 1], edge[:, 1, 0], edge[:, 1, 1] = (pairs @ self.pair).T
        inward = unary.copy()  # own potential and all messages from children
        up = np.zeros((n, 2))
        levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
        for level in reversed(levels[1:]):
            up[level] = np.logaddexp(
                edge[level, :, 0] + inward[level, None, 0], edge[level, :, 1] + inward[level, None, 1]
            )
            np.add.at(inward, parents[level], up[level])
        belief = inward.copy()
        joint = np.zeros((n, 2, 2))
        for level in levels[1:]:
            rest = belief[parents[level]] - up[level]  # all of the parent but this child
            both = rest[:, :, None] + edge[level] + inward[level][:, None, :]
            down = np.logaddexp(both[:, 0, :], both[:, 1, :])
            belief[level] = down
            joint[level] = np.exp(both - np.logaddexp(down[:, 0], down[:, 1])[:, None, None])
        z = np.logaddexp(belief[:, 0], belief[:, 1])
        roots = levels[0]
        return np.exp(belief[:, 1] - z), joint, float(np.logaddexp(inward[roots, 0], inward[roots, 1]).sum())


def together(pages: list[list[Node]]):
    """Trees side by side: (x, pairs, parents, depth, first node of each page)."""
    parts = [features(nodes) for nodes in pages]
    starts = np.cumsum([0] + [len(p) for p in pages])
    parents = [np.where(p >= 0, p + s, -1) for (_, p, _), s in zip(parts, starts, strict=False)]
    return (
        np.concatenate([x for x, _, _ in parts]),
        np.concatenate([pair_features(nodes) for nodes in pages]),
        np.concatenate(parents),
        np.concatenate([d for _, _, d in parts]),
        starts,
    )


def train(labelled: list[tuple[list[Node], np.ndarray]], steps: int = 400, rate: float = 0.3) -> Model:
    """Ascend the likelihood of the labels: expected features meet those observed."""
    x, pairs, parents, depth, _ = together([nodes for nodes, _ in labelled])
    y = np.concatenate([labels for _, labels in labelled]).astype(np.int64)
    held = parents >= 0
    seen = np.zeros((len(y), 2, 2))
    seen[held, y[parents[held]], y[held]] = 1.0
    model = Model(np.zeros(x.shape[1]), np.zeros((pairs.shape[1], 3)))
    speed = [np.zeros_like(model.node), np.zeros_like(model.pair)]
    for _ in range(steps):
        p, joint, _ = model.marginals(x, pairs, parents, depth)
        gap = seen - joint
        slopes = [
            x.T @ (y - p) / len(y) - 2e-4 * model.node,
            pairs.T @ np.stack([gap[:, 0, 1], gap[:, 1, 0], gap[:, 1, 1]], 1) / len(y) - 2e-4 * model.pair,
        ]
        for weight, v, slope in zip((model.node, model.pair), speed, slopes, strict=True):
            v *= 0.9
            v += slope
            weight += rate * v
    return model


def trained() -> Model:
    pages = []
    for page, content in labelled_pages():
        nodes = parse(page)
        labels = np.array([any(c in "".join(t for _, t in n.texts) for c in content) for n in nodes], bool)
        # A block around content is content; so is a block without text within it.
        for i in range(len(nodes) - 1, 0, -1):
            labels[nodes[i].parent] |= labels[i] and nodes[nodes[i].parent].tag not in ("html", "body")
        pages.append((nodes, labels))
    return train(pages)


def block_texts(nodes: list[Node], content: np.ndarray) -> str:
    """Text of content nodes in page order; runs of one block join into one text."""
    runs = sorted((place, i, t) for i, n in enumerate(nodes) if content[i] for place, t in n.texts)
    out: list[str] = []
    last = None
    for place, i, t in runs:
        if last == i and out:
            out[-1] += t
        else:
            out.append(t)
        last = i
    return " ".join(c for c in (_SPACE.sub(" ", t).strip() for t in out) if c)


def extract(df: DataFrame, html: str = "html", name: str = "text", at_once: int = 200) -> DataFrame:
    """``df`` with the main text of each page as a last column ``name``.

    Character references are decoded, white space within a block becomes one space, and
    blocks are joined in page order by one. Null, empty and contentless pages give an
    empty text. Nothing else is dropped or cut, however long. Rows that repeat give equal
    texts; an empty frame stays empty; other columns are untouched, a column called
    ``name`` excepted, which is replaced.
    """
    model = trained()
    keep = [c for c in df.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lo in range(0, batch.num_rows, at_once):
                pages = [parse(t.as_py()) for t in batch.column(batch.num_columns - 1).slice(lo, at_once)]
                x, pairs, parents, depth, starts = together(pages)
                p, _, _ = model.marginals(x, pairs, parents, depth)
                for nodes, s in zip(pages, starts, strict=False):
                    out.append(block_texts(nodes, p[s : s + len(nodes)] >= 0.5))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.string())], names=[*keep, name]
            )

    whole = df.select(*cols(keep), col(html).alias(hidden(df, "_html")))
    schema = T.StructType([*df.select(*cols(keep)).schema, T.StructField(name, T.StringType())])
    return whole.mapInArrow(run, schema)


def op4(df: DataFrame) -> DataFrame:
    """Every page's main text and its number of code points."""
    found = extract(df.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
