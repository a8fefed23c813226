"""A page as a tree of its blocks with what a classifier reads of each node."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np

#: Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style noscript template textarea select option button iframe object svg math canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY_BLOCK = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDS_OF = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
           "th": ("td th", "tr table"), "tbody": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tfoot tr td th", "table")}
TAGS = ("p h1 h2 h3 h4 h5 h6 div section article main nav header footer aside form ul ol li dl dt dd table tr td th blockquote pre figure figcaption "
        "a span details body").split()
TAG_NUMBER = {t: i for i, t in enumerate(TAGS)}
LANDMARKS = "article main nav header footer aside form section ul table".split()

_TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE = re.compile(r"[.!?…。](?:\s|$)")


class Node:
    __slots__ = ("tag", "tokens", "parent", "depth", "children", "blocks", "hidden", "label", "open",
                 "chars", "links", "tags", "stops", "own", "paragraphs", "items")

    def __init__(self, tag: str, parent: Node | None, tokens: tuple[str, ...], hidden: bool, label: int | None):
        self.tag, self.parent, self.tokens, self.hidden, self.label = tag, parent, tokens, hidden, label
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node] = []
        self.blocks: list[tuple[int, str]] = []  # place in the page, text
        self.open: list[str] = []
        self.chars = self.links = self.tags = self.stops = self.own = self.paragraphs = self.items = 0


def attribute_tokens(source: str) -> tuple[tuple[str, ...], dict[str, str]]:
    said = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)} if source.strip(" /\n\t\r") else {}
    names = [t.lower() for k in ("class", "id", "role", "itemprop") if k in said for t in _TOKEN.findall(unescape(said[k]))]
    if "hidden" in said or "none" in said.get("style", "") or said.get("aria-hidden") == "true":
        names.append("hidden")
    return tuple(dict.fromkeys(names)), said


def parse(html: str, labelled: bool = False) -> list[Node]:
    """The nodes of a page in page order, the root first: block elements, and inline ones that attributes name.

    A block is a stretch of text that no block's tag interrupts, its white space made single blanks. Only training pages are ``labelled``, by ``data-keep``.
    """
    root = Node("body", None, (), False, None)
    nodes, stack = [root], [(root, "body")]
    links, place, at, end = 0, 0, 0, len(html)

    def flush(node: Node) -> None:
        nonlocal place
        if node.open:
            text = " ".join(unescape("".join(node.open)).split())
            node.open = []
            if text and not node.hidden:
                node.blocks.append((place, text))
                node.own += len(text)
                node.stops += len(_SENTENCE.findall(text))
                place += 1

    def holder() -> Node:
        """The nearest block: inline elements that are nodes hold text of their own, parted from what stands around them."""
        return stack[-1][0]

    def leave(k: int) -> None:
        nonlocal links
        while len(stack) > k:
            node, tag = stack.pop()
            if tag == "a":
                links -= 1
            if node is not stack[-1][0]:
                flush(node)

    while at < end:
        m = _TAG.search(html, at)
        text = html[at : m.start() if m else end]
        if text:
            node = holder()
            node.open.append(text)
            if links and not node.hidden:
                node.links += len(text.strip())
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] == tag:
                    if tag in INLINE and any(t not in INLINE for _, t in stack[k + 1 :]):
                        break  # an inline end does not close blocks
                    leave(k)
                    break
            continue
        if tag in ("html", "body"):
            continue
        if tag == "br" or tag == "hr":
            holder().open.append(" ")
            if tag == "br":
                continue
        if tag in CLOSED_BY_BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] == "p":
                    leave(k)
                    break
                if stack[k][1] not in INLINE:
                    break
        if tag in ENDS_OF:
            closes, scope = (x.split() for x in ENDS_OF[tag])
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] in scope:
                    break
                if stack[k][1] in closes:
                    leave(k)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
        if tag in VOID:
            continue
        parent = holder()
        tokens, said = attribute_tokens(m[3]) if m[3] else ((), {})
        if tag in INLINE and not tokens:
            stack.append((parent, tag))
        else:
            if tag not in INLINE:
                flush(parent)
            elif parent.open:
                flush(parent)
            label = int(said["data-keep"]) if labelled and "data-keep" in said else parent.label
            node = Node(tag, parent, tokens, parent.hidden or tag in HIDDEN, label)
            parent.children.append(node)
            nodes.append(node)
            stack.append((node, tag))
        if tag == "a":
            links += 1
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            if tag in ("script", "style") or not close:
                at = close.start() if close else end
            else:
                holder().open.append(html[at : close.start()])
                at = close.start()
    while stack:
        node, _ = stack.pop()
        if not stack or node is not stack[-1][0]:
            flush(node)
    for node in reversed(nodes):
        node.chars += node.own
        node.links = min(node.links, node.chars) if not node.children else node.links
        up = node.parent
        if up:
            up.chars += node.chars
            up.links += node.links
            up.tags += node.tags + 1
            up.stops += node.stops
            up.paragraphs += node.paragraphs + (node.tag == "p")
            up.items += node.items + (node.tag == "li")
    return nodes


NUMBERS = ["depth", "chars", "own", "density", "link_share", "stops", "stops_share", "paragraphs", "items", "tags", "place", "siblings", "alike",
           "share", "before", "after", "after_share", "parent_chars", "parent_links", "deepest_landmark"]


def features(nodes: list[Node], tokens: dict[str, int]) -> np.ndarray:
    """A row per node: subtree density, links, siblings, depth, place; tags of the node and its parent; landmarks and
    attribute tokens of the node or an ancestor, and of the node alone."""
    wide = len(NUMBERS) + 2 * (len(TAGS) + 1) + len(LANDMARKS) + 2 * len(tokens)
    out = np.zeros((len(nodes), wide), np.float32)
    total = max(nodes[0].chars, 1)
    number = {id(n): i for i, n in enumerate(nodes)}
    tag_at = len(NUMBERS)
    parent_at = tag_at + len(TAGS) + 1
    land_at = parent_at + len(TAGS) + 1
    near_at = land_at + len(LANDMARKS)
    self_at = near_at + len(tokens)
    # tags of each node's children, counted once: a node may have any number of them
    tags_below = {id(n): Counter(c.tag for c in n.children) for n in nodes if n.children}
    seen = 0
    for i, n in enumerate(nodes):
        row, up = out[i], n.parent
        if up:
            above = out[number[id(up)]]
            row[land_at:self_at] = above[land_at:self_at]
            size = len(up.children)
            alike = tags_below[id(up)][n.tag]
            row[: len(NUMBERS)] = (
                n.depth, n.chars, n.own, n.chars / (n.tags + 1), n.links / max(n.chars, 1), n.stops, n.stops / (n.chars / 50 + 1), n.paragraphs, n.items,
                n.tags, i / len(nodes), size, alike, n.chars / max(up.chars, 1), seen / total, total - seen, (total - seen) / total,
                up.chars, up.links / max(up.chars, 1), 0)
            row[parent_at + TAG_NUMBER.get(up.tag, len(TAGS))] = 1
        row[tag_at + TAG_NUMBER.get(n.tag, len(TAGS))] = 1
        if n.tag in LANDMARKS:
            row[land_at + LANDMARKS.index(n.tag)] = 1
        for t in n.tokens:
            k = tokens.get(t)
            if k is not None:
                row[near_at + k] = row[self_at + k] = 1
        if not n.hidden:
            seen += n.own
    return out


def decode(nodes: list[Node], score: np.ndarray, bound: float = 4.0) -> str:
    """The text of the best consistent choice.

    On the way down a node is above the article, then in it, then out of it, and never back: nothing below what is out is kept, and what
    lies in the article is never above it. ``score`` is the log odds that a node is part of the article; the choice has the greatest sum.
    """
    s = np.clip(score, -bound, bound).tolist()
    number = {id(n): i for i, n in enumerate(nodes)}
    inside, outside, above = [0.0] * len(nodes), [0.0] * len(nodes), [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        if n.hidden:
            inside[i] = above[i] = float("-inf")
            continue
        inside[i] += s[i]
        outside[i] -= s[i]
        if n.parent and not n.parent.hidden:
            up = number[id(n.parent)]
            inside[up] += max(inside[i], outside[i])
            outside[up] += outside[i]
            above[up] += max(above[i], inside[i], outside[i])
    state = [""] * len(nodes)
    blocks: list[tuple[int, str]] = []
    for i, n in enumerate(nodes):
        if n.parent is None:
            state[i] = "above"
        else:
            up = state[number[id(n.parent)]]
            if n.hidden or up == "out":
                state[i] = "out"
            elif up == "in":
                state[i] = "in" if inside[i] > outside[i] else "out"
            else:
                best = max(above[i], inside[i], outside[i])
                state[i] = "in" if inside[i] == best and n.blocks or inside[i] == best > above[i] else "out" if outside[i] == best else "above"
        if state[i] == "in":
            blocks += n.blocks
    return "\n".join(t for _, t in sorted(blocks))
