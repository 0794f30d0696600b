"""Benchmark decontamination over a distributed positional inverted index of the training documents.

The index is a written table, one row per block of whole documents: the block's distinct terms (hashes, sorted), where each
term's postings begin, the postings (word positions in the block, ascending) and the documents' bounds. Blocks need nothing
from each other, so no posting is ever shuffled and a word that stands in every document is spread over all blocks.

Test passages are cut into windows of `WINDOW` consecutive words. They are asked in blocks of at most `QUERY_WINDOWS` windows, so
what a task is given never grows with the benchmark. In an index block a window whose terms are not all there is dropped; for
the others the rarest term's postings, moved back by its offset, are the candidate places, and the next rarer terms' postings
are intersected with them. Places left after all terms are exact phrase matches. Proximity: an item is near a document if all
terms of one of its windows stand in some stretch of `near` words there, in any order; only stretches around the rarest term's
postings are looked at. Proximity is asked for with `NEAR`, which leaves room for two more words in a window; exact columns are
the same with and without it. Where `near` is None only exact matches are sought.

Defined cases: null or empty texts have no words and are clean; an item without words has no window; items with a null id hit
words but are not listed; equal items hit alike; repeated documents are judged one by one; an empty benchmark leaves all clean; an empty table gives no row. Document
ids are whole numbers (or null); `contamination` returns its own columns only, `clean` all of the rows', whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.frames import whole_row
from docmill.llm.kernels import ALNUM, slices
from docmill.session import work_dir, written

WINDOW = 10
NEAR = WINDOW + 2
BLOCK_BYTES = 1 << 21
QUERY_WINDOWS = 100_000
INDEX = "block long, doc_ids array<long>, text_keys array<long>, first binary, terms binary, starts binary, postings binary"
HITS = "block long, doc_no int, doc_id long, text_key long, n_words long, covered array<int>, items array<string>, near_items array<string>"


def build_index(docs: DataFrame) -> DataFrame:
    """Write the positional index of doc_id and text to the shared folder and read it back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
            for part in slices(batch.column("text"), lower=True, limit=BLOCK_BYTES):
                part.words(ALNUM)
                order = np.argsort(part.hash, kind="stable").astype(np.uint32)
                sorted_hash = part.hash[order]
                begin = np.flatnonzero(np.r_[True, sorted_hash[1:] != sorted_hash[:-1]]) if len(order) else np.zeros(0, np.int64)
                blobs = [part.first.astype(np.int64), sorted_hash[begin], np.r_[begin, len(order)].astype(np.int64), order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int64()), *(pa.array([x[part.lo : part.hi]], pa.list_(pa.int64())) for x in (ids, keys)), *(pa.array([b.tobytes()], pa.binary()) for b in blobs)],
                    ["block", "doc_ids", "text_keys", "first", "terms", "starts", "postings"],
                )

    path = work_dir(docs.sparkSession, "postings")
    made = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, INDEX)
    made.withColumn("block", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(INDEX).parquet(path)


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (item, terms) of all windows; terms are the hashes of the words in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item").to_pylist()
            for part in slices(batch.column("text"), lower=True):
                part.words(ALNUM)
                item, terms = [], []
                for i, (a, b) in enumerate(zip(part.first[:-1], part.first[1:], strict=True)):
                    own = {part.hash[k : k + size].tobytes() for k in range(a, max(b - size + 1, a + (b > a)))} if b - a >= size else {part.hash[a:b].tobytes()} - {b""}
                    item += [ids[part.lo + i]] * len(own)
                    terms += sorted(own)
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(terms, pa.binary())], ["item", "terms"])

    return items.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(run, "item string, terms binary").distinct()


class Queries:
    """A bounded block of windows as arrays: terms by number (-1: none), padded to the longest window."""

    def __init__(self, rows: list[tuple[str | None, bytes]]):
        self.items = [r[0] for r in rows]
        words = [np.frombuffer(r[1], np.uint64) for r in rows]
        self.length = np.array([len(w) for w in words], np.int64)
        self.terms, back = np.unique(np.concatenate(words) if words else np.zeros(0, np.uint64), return_inverse=True)
        self.number = np.full((len(rows), int(self.length.max(initial=1))), -1, np.int64)
        self.number[np.arange(self.number.shape[1]) < self.length[:, None]] = back


def match(q: Queries, first: np.ndarray, terms: np.ndarray, starts: np.ndarray, postings: np.ndarray, near: int | None):
    """(window, start) of the exact phrase matches in one index block, and (window, place of its rarest term) of the near ones."""
    none = np.zeros(0, np.int64)
    if not len(q.items) or not len(terms):
        return none, none, none, none
    at = np.minimum(np.searchsorted(terms, q.terms), len(terms) - 1)
    there = terms[at] == q.terms
    count = np.r_[np.where(there, starts[at + 1] - starts[at], 0), np.iinfo(np.int64).max]  # the last: padding
    live = np.flatnonzero((count[q.number] > 0).all(axis=1))
    if not len(live):
        return none, none, none, none
    order = np.argsort(count[q.number[live]], axis=1, kind="stable")  # offsets, rarest term first
    rare = at[q.number[live, order[:, 0]]]
    n = starts[rare + 1] - starts[rare]
    who = np.repeat(np.arange(len(live)), n)
    place = postings[np.repeat(starts[rare] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())].astype(np.int64)
    keys = (np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(starts)) << 32) | postings
    doc = np.searchsorted(first, place, side="right") - 1

    exact_who, start = who, place - order[who, 0]
    length = q.length[live]
    inside = (start >= first[doc]) & (start + length[who] <= first[doc + 1])
    exact_who, start = exact_who[inside], start[inside]
    near_who, near_at, near_doc = (who, place, doc) if near else (none, none, none)
    for j in range(1, q.number.shape[1]):
        offset = order[exact_who, j]
        term = q.number[live[exact_who], offset]
        want = (at[term] << 32) | (start + offset)
        stay = (term < 0) | (keys[np.minimum(np.searchsorted(keys, want), len(keys) - 1)] == want)
        exact_who, start = exact_who[stay], start[stay]
        term = q.number[live[near_who], order[near_who, j]]
        if near:
            stay = (term < 0) | _stands(keys, at[term], near_at - near + 1, near_at + near, first, near_doc)
            near_who, near_at, near_doc = near_who[stay], near_at[stay], near_doc[stay]
    if near and len(near_who):  # every stretch around a place that still has all terms on either side
        near_who, near_at, near_doc = (np.repeat(x, near) for x in (near_who, near_at, near_doc))
        begin = near_at - np.tile(np.arange(near), len(near_at) // near)
        stay = np.ones(len(begin), bool)
        for j in range(1, q.number.shape[1]):
            term = q.number[live[near_who], order[near_who, j]]
            stay &= (term < 0) | _stands(keys, at[term], begin, begin + near, first, near_doc)
        near_who, near_at = near_who[stay], near_at[stay]
    return live[exact_who], start, live[near_who], near_at


def _stands(keys: np.ndarray, term: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether the term has a posting in [begin, end) of the document."""
    low = (term << 32) | np.maximum(begin, first[doc])
    high = (term << 32) | np.minimum(end, first[doc + 1])
    return np.searchsorted(keys, high) > np.searchsorted(keys, low)


def find(index: DataFrame, rows: list[tuple[str | None, bytes]], near: int | None = None) -> DataFrame:
    """One row per document: the word ranges covered by exact matches (start, end by turns), the items, the items near it."""
    shared = index.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Queries(shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                blob = {c: np.frombuffer(batch.column(c)[row].as_py(), t) for c, t in (("first", np.int64), ("terms", np.uint64), ("starts", np.int64), ("postings", np.uint32))}
                ids, first = batch.column("doc_ids")[row].as_py(), blob["first"]
                window, start, near_window, near_at = match(q, first, blob["terms"], blob["starts"], blob["postings"], near)
                covered, items, near_items = ([[] for _ in ids] for _ in range(3))
                order = np.argsort(start, kind="stable")
                doc = np.searchsorted(first, start, side="right") - 1
                for i in order:
                    d, a, b = doc[i], int(start[i] - first[doc[i]]), int(start[i] - first[doc[i]] + q.length[window[i]])
                    if covered[d] and a <= covered[d][-1]:
                        covered[d][-1] = max(b, covered[d][-1])
                    else:
                        covered[d] += [a, b]
                    if q.items[window[i]] is not None:
                        items[d].append(q.items[window[i]])
                for w, d in set(zip(near_window.tolist(), (np.searchsorted(first, near_at, side="right") - 1).tolist(), strict=True)):
                    if q.items[w] is not None:
                        near_items[d].append(q.items[w])
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("block")[row].as_py()] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int32()), pa.array(ids, pa.int64()),
                    batch.column("text_keys")[row].values, pa.array(np.diff(first)), pa.array(covered, pa.list_(pa.int32())), pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
                    pa.array([sorted(set(x)) for x in near_items], pa.list_(pa.string())),
                ], ["block", "doc_no", "doc_id", "text_key", "n_words", "covered", "items", "near_items"])

    return index.mapInArrow(run, HITS)


def search(index: DataFrame, items: DataFrame, size: int = WINDOW, near: int | None = None) -> DataFrame:
    """Matches of all items in all documents, the windows asked in blocks of bounded size."""
    asked = windows(items, size)
    path = work_dir(index.sparkSession, "windows")
    asked.write.parquet(path)
    asked = index.sparkSession.read.schema("item string, terms binary").parquet(path)
    blocks = max(1, -(-asked.count() // QUERY_WINDOWS))
    spread = F.pmod(F.xxhash64("item", "terms"), F.lit(blocks))
    if blocks == 1:
        return find(index, [tuple(r) for r in asked.collect()], near)
    # One block after another: its windows are collected, sent, matched and its hits stored before the next one's are collected.
    found = [written(find(index, [tuple(r) for r in asked.where(spread == b).collect()], near), "hits") for b in range(blocks)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("block", "doc_no").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("covered")).alias("covered"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"),
    )


def _hit_words(covered):
    """Words in the union of (start, end) ranges."""
    steps = F.when(F.size(covered) > 0, F.sequence(F.lit(0), F.size(covered) - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.size(F.array_distinct(F.flatten(F.transform(steps, lambda i: F.sequence(F.get(covered, i), F.get(covered, i + 1) - 1))))).cast("long")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, near: int | None = NEAR) -> DataFrame:
    """Per document: words, words hit, items with occurring windows and their digest, the verdict, and the items near it."""
    found = search(build_index(docs), items, size, near)
    return found.select(
        "doc_id", "n_words", _hit_words(F.col("covered")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("covered") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"), F.array_sort("near_items").alias("near_items"),
    )


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW, near: int | None = None) -> DataFrame:
    """The rows that hold no window of any item and, with `near`, are near none; rows are told apart by id and text."""
    hit = search(build_index(docs), items, size, near).where((F.size("covered") > 0) | (F.size("near_items") > 0)).select(F.col("doc_id").alias("hit_id"), "text_key").distinct()
    rows = docs.select(whole_row(docs), F.xxhash64("text").alias("own_key"))
    return rows.join(hit, F.col("row.doc_id").eqNullSafe(F.col("hit_id")) & (F.col("own_key") == F.col("text_key")), "left_anti").select("row.*")


#: DuckDB: every window of every document joined with every window of every item; for proximity, stretches around the rarest term.
WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
asked AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[k:k + least(len(w), {WINDOW}) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS k FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM asked),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
),
hits AS (SELECT doc_id, item_id, k, n FROM places JOIN asked USING (n, p)),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
),
occurrences AS (SELECT doc_id, w, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM d),
rarity AS (SELECT term, count(*) AS n FROM occurrences GROUP BY term),
sets AS (SELECT DISTINCT item_id, list_sort(list_distinct(string_split(p, ' '))) AS terms FROM asked),
rarest AS (
  SELECT item_id, terms, arg_min(term, n) AS term
  FROM (SELECT item_id, terms, unnest(terms) AS term FROM sets) JOIN rarity USING (term) GROUP BY item_id, terms HAVING count(*) = len(terms)
),
around AS (
  SELECT DISTINCT doc_id, item_id, terms, pos, w[greatest(pos - {NEAR} + 1, 1):pos + {NEAR} - 1] AS nearby
  FROM occurrences JOIN rarest USING (term) WHERE list_has_all(w[greatest(pos - {NEAR} + 1, 1):pos + {NEAR} - 1], terms)
),
near AS (
  SELECT doc_id, count(*) AS n_near, string_agg(i, ',' ORDER BY i) AS joined
  FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i
    FROM (SELECT doc_id, item_id, terms, nearby, unnest(range(1, len(nearby) + 1)) AS k FROM around)
    WHERE list_has_all(nearby[k:k + {NEAR} - 1], terms)
  ) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(found.joined, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
  coalesce(n_near, 0) AS n_near_items, coalesce(near.joined, '') AS near_items
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN near USING (doc_id)
"""
