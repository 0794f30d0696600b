"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded from the root down without contradictions.

Each block node (an element, or a run of text between block borders) is scored for three states: out (nothing below it is main
text), in (all of it is), mixed. Features are its subtree's density, links, marks and counts, the words of its class, id and
role, those of its ancestors and of what is below it (as learnt log-odds), depth, place, and its siblings (`dom`). The page's
decoding is the most likely assignment of states in which everything below an out node is out and everything below an in node is
in: sums over subtrees from the leaves up, choices from the root down, level by level over all nodes of a slice at once.

The trees are trained in the driver on a bounded sample, at most `SAMPLE_PAGES` pages of at most `SAMPLE_CHARS` characters, chosen by a
hash of the page: those with one `article` or `main` element as they are, menus, asides, forms and the like inside it being out, and
`LAYOUTS` pages in which texts of the sample are set anew (`layouts`). No table gives labels for pages. All pages are extracted.

A block's white space becomes one blank (a line break, too), blocks are joined by a line feed. Scripts, styles, form controls and
comments of the markup are never text. A heading inside the article belongs to it.

Defined cases: a null or empty page, and one without main text, give an empty text; equal pages give equal texts; unclosed, crossed and
unknown tags are read as browsers read them, text outside all elements is a block; nothing is cut from long pages; null ids
and urls stay; other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm import boosting
from docmill.llm.dom import NUMBER, Nodes, Tree, features, word_weights
from docmill.llm.layouts import Layouts

SAMPLE_PAGES, SAMPLE_CHARS = 200, 50_000
LAYOUTS = 500
TRAIN_NODES = 16_000
OUT, MIXED, IN = range(3)
SLICE_CHARS = 1 << 20
_NOT_MAIN = [NUMBER[k] for k in ("nav", "header", "footer", "aside", "form", "dialog")]
#: Texts for layouts where no page of the sample has any.
_FILLER = ["One text, and no more.", "Word."]


@dataclass
class Model:
    """Trees, and the log-odds of attribute words that their features need."""

    trees: boosting.Trees
    words: dict[str, float]


def _states(tree: Tree, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node's state by the labels of its runs, and which nodes have any text."""
    run = tree.kind == NUMBER["run"]
    kept, runs = tree.subtree((run & (label == 1)).astype(float)), tree.subtree(run.astype(float))
    return np.where(kept == 0, OUT, np.where(kept == runs, IN, MIXED)), runs > 0


def marked(nodes: Nodes, tree: Tree) -> np.ndarray:
    """Labels of pages that name their main text by one element: 1 in it, 0 outside and in its menus and the like."""
    main = (tree.kind == NUMBER["article"]) | (tree.kind == NUMBER["main"])
    count = np.bincount(tree.page[main], minlength=len(tree.first) - 1)
    state = np.zeros(tree.n, np.int64)
    for level in tree.levels:
        up = np.maximum(tree.parent[level], 0)
        above = np.where(tree.parent[level] >= 0, state[up], 0)
        state[level] = np.where(main[level], 1, np.where(np.isin(tree.kind[level], _NOT_MAIN), 0, above))
    return np.where(count[tree.page] == 1, state, -1)


def train_on(pages: list[str], seed: int = 5, layouts: int = LAYOUTS) -> Model:
    """Model from sampled pages."""
    own = Nodes()
    for page in pages:
        own.add_page(page)
    tree = Tree(own)
    label = marked(own, tree) if tree.n else np.zeros(0, np.int64)
    run, kind = tree.kind == NUMBER["run"], tree.kind
    heading = run & (kind[np.maximum(tree.parent, 0)] == NUMBER["head"])
    texts = np.array(own.text, object)
    linked = tree.linked > 0.5 * np.maximum(tree.chars, 1)
    headings, paragraphs, shorts = (list(texts[x]) or _FILLER for x in (heading, run & ~heading & ~linked, run & (linked | (tree.chars < 30))))
    drawn = Nodes(labelled=True)
    draw = Layouts(seed, headings, paragraphs, shorts)
    for _ in range(layouts):
        drawn.add_page(draw.page())
    drawn_tree = Tree(drawn)
    both = [(own, tree, label), (drawn, drawn_tree, np.array(drawn.label))]
    state, some = _states(drawn_tree, both[1][2])
    words = word_weights(drawn, some & (state == OUT), some & (state == IN))
    x, y = [], []
    for nodes, t, known in both:
        if t.n:
            state, some = _states(t, known)
            use = some & (known >= 0)
            x.append(features(nodes, t, words)[use])
            y.append(state[use])
    x, y = np.concatenate(x), np.concatenate(y)
    if len(x) > TRAIN_NODES:
        use = np.random.default_rng(seed).permutation(len(x))[:TRAIN_NODES]
        x, y = x[use], y[use]
    return Model(boosting.fit(x, y, 3), words)


def train(pages: DataFrame) -> Model:
    """Model from the bounded sample of pages; the driver holds no other page.

    Rows whose hash is under a share of about 4 * SAMPLE_PAGES rows come together, repeated ones once; the smallest hashes
    among them are taken. So what the tasks send does not grow with their number.
    """
    n = pages.count()
    key = F.xxhash64(F.col("page_id").cast("string"), "html")
    few = pages.select(key.alias("key"), "html").where(F.col("html").isNotNull() & (F.length("html") <= SAMPLE_CHARS))
    few = few.where(F.pmod("key", F.lit(max(1, n // (4 * SAMPLE_PAGES)))) == 0).groupBy("key").agg(F.min("html").alias("html"))
    return train_on([r.html for r in few.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_PAGES).collect()])


def decode(tree: Tree, log_chance: np.ndarray) -> np.ndarray:
    """Which nodes are in: the likeliest states without contradictions."""
    leaf = tree.end == np.arange(tree.n) + 1
    out, inside = tree.subtree(log_chance[:, OUT]), tree.subtree(log_chance[:, IN])
    best, below = np.empty(tree.n), np.zeros(tree.n)
    mixed = log_chance[:, MIXED].copy()
    mixed[leaf] = -np.inf
    for level in reversed(tree.levels):
        best[level] = np.maximum(np.maximum(out[level], inside[level]), mixed[level] + below[level])
        up = tree.parent[level]
        np.add.at(below, up[up >= 0], best[level][up >= 0])
    own = np.where(inside == best, IN, np.where(out == best, OUT, MIXED))
    state = np.empty(tree.n, np.int64)
    for level in tree.levels:
        up = tree.parent[level]
        above = np.where(up >= 0, state[np.maximum(up, 0)], MIXED)
        state[level] = np.where(above == MIXED, own[level], above)
    return state == IN


def texts_of(model: Model, pages: list[str]) -> list[str]:
    """Main text of each page."""
    nodes = Nodes()
    for page in pages:
        nodes.add_page(page)
    tree = Tree(nodes)
    if not tree.n:
        return []
    kept = decode(tree, model.trees.log_chances(features(nodes, tree, model.words))) & (tree.kind == NUMBER["run"])
    out: list[list[str]] = [[] for _ in pages]
    for i in np.flatnonzero(kept):
        out[tree.page[i]].append(nodes.text[i])
    return ["\n".join(x) for x in out]


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    model = model or train(pages)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html, lo = batch.column("html"), 0
            while lo < len(html):
                part: list[str] = []
                size = 0
                while lo + len(part) < len(html) and (not part or size < SLICE_CHARS):
                    part.append(html[lo + len(part)].as_py() or "")
                    size += len(part[-1])
                texts = texts_of(shared.value, part)
                rows = batch.slice(lo, len(part))
                yield pa.RecordBatch.from_arrays([
                    rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                ], ["page_id", "url", "text", "n_chars"])
                lo += len(part)

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)


#: Reference for pages whose only sign of the main text is one bare `article` element of headings and paragraphs, as in the given tables.
SQL = r"""
WITH body AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS inside FROM pages
), blocks AS (
  SELECT page_id, url, list_transform(regexp_split_to_array(inside, '</?(?:p|h1)>'), lambda x: regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g')) AS b FROM body
), decoded AS (
  SELECT page_id, url, list_transform(b, lambda x: regexp_replace(replace(replace(replace(regexp_replace(x, '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>'), '&#x27;', chr(39)), '&amp;?', '&', 'g')) AS b FROM blocks
), clean AS (
  SELECT page_id, url, list_filter(list_transform(b, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS b FROM decoded
)
SELECT page_id, url, array_to_string(b, chr(10)) AS text, length(array_to_string(b, chr(10)))::BIGINT AS n_chars FROM clean
"""
