"""Web pages as flat tables of block nodes, in page order, and what the extraction model sees of each node.

A node is a block element or, as a leaf, a run of text between block borders; inline markup only leaves its traces in the counts
(links). Subtrees are index ranges, so every sum over a subtree is one difference of running sums.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np

# Block elements by kind, elements without text of their own, ends that the next start tag implies.
KINDS = {
    "article": "article", "main": "main", "section": "section", "div": "div", "center": "div", "p": "p", "h1": "head", "h2": "head", "h3": "head",
    "h4": "head", "h5": "head", "h6": "head", "ul": "list", "ol": "list", "dl": "list", "menu": "list", "dir": "list", "li": "item", "dt": "item",
    "dd": "item", "nav": "nav", "header": "header", "hgroup": "header", "footer": "footer", "aside": "aside", "form": "form", "fieldset": "form",
    "legend": "form", "search": "form", "table": "table", "thead": "table", "tbody": "table", "tfoot": "table", "tr": "row", "td": "cell", "th": "cell",
    "caption": "cell", "blockquote": "quote", "figure": "figure", "figcaption": "figure", "pre": "pre", "details": "details", "summary": "details",
    "dialog": "dialog", "address": "address",
}
SILENT = frozenset("head title script style template noscript textarea select option optgroup button svg math iframe object video audio canvas datalist".split())
IN_HEAD = frozenset("title meta link script style base noscript template".split())
CONTROLS = frozenset("input button select textarea".split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"table"}),
        "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
        "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
BARRIERS = frozenset(("td", "th", "table"))
NAMES = ["root", "run", *dict.fromkeys(KINDS.values())]
NUMBER = {name: i for i, name in enumerate(NAMES)}
INHERITED = [NUMBER[n] for n in ("article", "main", "section", "nav", "header", "footer", "aside", "form", "list", "table", "quote", "dialog")]
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARKS = re.compile(r"[.,;:!?]")
#: Class, id and role: what a page's author calls a node.
NAMING = ("class", "id", "role", "itemprop", "aria-label")
LABEL = "data-kept"


@lru_cache(maxsize=20_000)
def name_parts(value: str) -> frozenset[str]:
    """The words of an attribute: postBody-2 gives post and body."""
    return frozenset(x.lower() for x in _PART.findall(value))


class Nodes(HTMLParser):
    """Pages fed one after another; one entry per node in each list."""

    def __init__(self, labelled: bool = False):
        super().__init__(convert_charrefs=True)
        self.labelled = labelled
        self.page, self.parent, self.depth, self.kind, self.end = [], [], [], [], []
        self.parts, self.text, self.chars, self.linked, self.controls, self.label = [], [], [], [], [], []
        self.first = [0]

    def add_page(self, html: str) -> None:
        self.reset()
        self.stack: list[tuple[str, int, bool]] = []
        self.run: list[str] = []
        self.run_linked, self.link_at = 0, 0
        self._node("root", frozenset(), None)
        self.stack.append(("", len(self.kind) - 1, False))
        self.feed(html)
        self.close()
        while self.stack:
            self._pop()
        self.first.append(len(self.kind))

    def _node(self, name: str, parts: frozenset[str], label: int | None) -> int:
        up = self.stack[-1][1] if self.stack else -1
        self.page.append(len(self.first) - 1)
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1 if up >= 0 else 0)
        self.kind.append(NUMBER[name])
        self.end.append(0)
        self.parts.append(parts)
        self.text.append("")
        self.chars.append(0)
        self.linked.append(0)
        self.controls.append(0)
        self.label.append(label if label is not None else self.label[up] if up >= 0 else 0)
        return len(self.kind) - 1

    def _flush(self) -> None:
        """End the run of text, if there is one."""
        text = " ".join("".join(self.run).split()) if self.run else ""
        if text:
            at = self._node("run", frozenset(), None)
            self.text[at], self.chars[at], self.linked[at], self.end[at] = text, len(text), min(self.run_linked, len(text)), at + 1
        self.run, self.run_linked = [], 0

    def _pop(self) -> None:
        silent = self.stack[-1][2]
        if not silent:
            self._flush()
        _, at, _ = self.stack.pop()
        if not silent:
            self.end[at] = len(self.kind)
        if self.link_at > len(self.stack):
            self.link_at = 0

    def _pop_through(self, names: set[str], until: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in names:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in until:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self._pop()
        if tag in CONTROLS:
            self.controls[self.stack[-1][1]] += 1
        if tag == "br":
            self.run.append(" ")
        elif tag == "hr":
            self._flush()
        elif tag == "a":
            self.link_at = len(self.stack)
        elif tag in ("html", "body"):
            if len(self.stack) == 1:
                self.parts[self.stack[0][1]] |= self._named(attrs)
        elif tag in SILENT or tag in KINDS:
            if tag in KINDS and self.stack[-1][0] == "p":
                self._pop()
            if tag in ENDS:
                self._pop_through(*ENDS[tag])
            if tag in SILENT or self.stack[-1][2]:  # nothing inside a silent element is a node
                if tag in KINDS:
                    self._flush()
                self.stack.append((tag, self.stack[-1][1], True))
                return
            self._flush()
            label = next((int(v) for k, v in attrs if k == LABEL), None) if self.labelled else None
            self.stack.append((tag, self._node(KINDS[tag], self._named(attrs), label), False))

    def _named(self, attrs: list[tuple[str, str | None]]) -> frozenset[str]:
        parts = frozenset().union(*(name_parts(v) for k, v in attrs if v and k in NAMING)) if attrs else frozenset()
        unseen = any(k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and "display:none" in v.replace(" ", "") for k, v in attrs)
        return parts | {"hidden"} if unseen else parts

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.link_at = 0
        elif tag in KINDS or tag in SILENT:
            until = set() if tag in BARRIERS or KINDS.get(tag) in ("table", "row") else BARRIERS
            if tag in KINDS and not self.stack[-1][2]:
                self._flush()
            self._pop_through({tag}, until)

    def handle_data(self, data: str) -> None:
        if self.stack[-1][0] == "head" and not data.isspace():
            self._pop()
        if not self.stack[-1][2]:
            self.run.append(data)
            if self.link_at:
                self.run_linked += len(data.strip())

    def unknown_decl(self, data: str) -> None:
        """Marked sections are markup."""


def word_weights(nodes: Nodes, out: np.ndarray, inside: np.ndarray, least: int = 3) -> dict[str, float]:
    """For each attribute word of at least `least` nodes the log-odds of naming a node without main text rather than one of it."""
    counts: dict[str, list[int]] = {}
    for parts, is_out, is_in in zip(nodes.parts, out.tolist(), inside.tolist(), strict=True):
        for part in parts:
            mine = counts.setdefault(part, [0, 0, 0])
            mine[0] += is_out
            mine[1] += is_in
            mine[2] += 1
    share = np.log((out.sum() + 1) / (inside.sum() + 1))
    return {part: float(np.log((o + 0.5) / (i + 0.5)) - share) for part, (o, i, n) in sorted(counts.items()) if n >= least}


class Tree:
    """The nodes as arrays, and sums over subtrees."""

    def __init__(self, nodes: Nodes):
        self.parent, self.depth, self.kind, self.end = (np.array(x, np.int64) for x in (nodes.parent, nodes.depth, nodes.kind, nodes.end))
        self.page, self.first = np.array(nodes.page, np.int64), np.array(nodes.first, np.int64)
        self.chars, self.linked, self.controls = (np.array(x, float) for x in (nodes.chars, nodes.linked, nodes.controls))
        self.n = len(self.kind)
        order = np.argsort(self.depth, kind="stable")
        self.levels = np.split(order, np.searchsorted(self.depth[order], np.arange(1, self.depth.max(initial=0) + 1)))

    def subtree(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(self.n + 1)
        np.cumsum(values, out=total[1:])
        return total[self.end] - total[:-1]

    def siblings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place among the siblings, their number, and the numbers of the one before and after (-1: none)."""
        order = np.lexsort((np.arange(self.n), self.parent))
        new = np.ones(self.n, bool)
        new[1:] = (self.parent[order][1:] != self.parent[order][:-1]) | (self.parent[order][1:] < 0)
        group = np.cumsum(new) - 1
        start = np.flatnonzero(new)
        place, count = np.empty(self.n, np.int64), np.empty(self.n, np.int64)
        place[order] = np.arange(self.n) - start[group]
        count[order] = np.bincount(group)[group] if self.n else 0
        before, after = np.full(self.n, -1), np.full(self.n, -1)
        before[order[1:]] = np.where(new[1:], -1, order[:-1])
        after[order[:-1]] = np.where(new[1:], -1, order[1:])
        return place, count, before, after


def _word_columns(nodes: Nodes, tree: Tree, weights: dict[str, float]) -> np.ndarray:
    """Largest and smallest weight of a node's attribute words, the same over its ancestors, and the largest below it; 0 without any."""
    own = np.zeros((tree.n, 2))
    for i, parts in enumerate(nodes.parts):
        known = [weights[part] for part in parts if part in weights] if parts else ()
        if known:
            own[i] = max(0.0, *known), min(0.0, *known)
    above, below = np.zeros_like(own), np.zeros(tree.n)
    for level in tree.levels[1:]:
        up = tree.parent[level]
        above[level, 0] = np.maximum(own[up, 0], above[up, 0])
        above[level, 1] = np.minimum(own[up, 1], above[up, 1])
    for level in reversed(tree.levels[1:]):
        np.maximum.at(below, tree.parent[level], np.maximum(own[level, 0], below[level]))
    return np.concatenate([own, above, below[:, None]], axis=1)


def _below(tree: Tree, own: np.ndarray) -> np.ndarray:
    """For each node whether one of its descendants has the mark."""
    total = np.zeros((tree.n + 1, own.shape[1]), np.float32)
    np.cumsum(own, axis=0, out=total[1:])
    return (total[tree.end] - total[1:] > 0).astype(np.float32)


def _inherit(tree: Tree, own: np.ndarray) -> np.ndarray:
    """For each node whether one of its ancestors has the mark."""
    out = np.zeros_like(own)
    for level in tree.levels[1:]:
        up = tree.parent[level]
        out[level] = np.maximum(own[up], out[up])
    return out


def features(nodes: Nodes, tree: Tree, weights: dict[str, float]) -> np.ndarray:
    """One row per node."""
    kinds = np.zeros((tree.n, len(NAMES)), np.float32)
    kinds[np.arange(tree.n), tree.kind] = 1
    above = _inherit(tree, kinds[:, INHERITED])
    up = np.maximum(tree.parent, 0)
    marks = np.array([len(_MARKS.findall(t)) if t else 0 for t in nodes.text], float)
    is_run = (tree.kind == NUMBER["run"]).astype(float)
    chars, linked, n_marks, runs, controls = (tree.subtree(x) for x in (tree.chars, tree.linked, marks, is_run, tree.controls))
    longest = tree.subtree(tree.chars**2) / np.maximum(chars, 1)
    below = [tree.subtree(kinds[:, NUMBER[k]]) for k in ("p", "head", "item", "form", "article")]
    root = tree.first[tree.page]
    whole = np.maximum(chars[root], 1)
    size = (tree.end - np.arange(tree.n)).astype(float)
    place, count, before, after = tree.siblings()
    share = linked / np.maximum(chars, 1)
    dense = n_marks / np.maximum(chars, 1)
    running = np.concatenate([[0.0], np.cumsum(tree.chars)])[:-1]
    near = [np.where(at >= 0, x[np.maximum(at, 0)], -1) for at in (before, after) for x in (np.log1p(chars), share, tree.kind)]
    columns = [
        np.log1p(chars), np.log1p(runs), np.log1p(size), np.log1p(longest), np.log1p(chars / size), share, dense, np.log1p(controls),
        *(np.log1p(b) for b in below), runs / size, tree.depth, np.minimum(place, 50), np.minimum(count - 1 - place, 50), np.minimum(count, 50),
        chars / whole, chars / np.maximum(chars[up], 1), chars[up] / whole, share[up], np.log1p(longest[up]), np.log1p(below[0][up]), tree.kind[up],
        (running - running[root]) / whole, (running + chars - running[root]) / whole, *near,
    ]
    return np.concatenate([kinds, above, _below(tree, kinds), np.stack(columns, axis=1).astype(np.float32), _word_columns(nodes, tree, weights).astype(np.float32)], axis=1)
