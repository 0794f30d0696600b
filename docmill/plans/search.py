"""Ranked text search over tables: a table of queries in, ranked documents out.

Documents carry ``doc_key`` (any unique text), ``title`` and ``text``. Long texts never enter a
shuffle: postings carry keys, terms and counts, display columns are joined after the top-k cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions import french
from docmill.functions.text import fold_keyword, html_escape
from docmill.operators.filters import SearchFilters
from docmill.operators.layout import deal_out, explode_once
from docmill.operators.ranking import top_k_per_group
from docmill.session import written

TOP_K = 10
K1, B = 1.2, 0.75
# Fixed value: default weight of the title field.
TITLE_BOOST = 2.0
# Characters of a fragment, fragments of a text.
FRAGMENT_SIZE, FRAGMENTS = 150, 3
FIELDS = {"title": "title", "text": "text"}
FILTERABLE = ("source", "decision_type", "decision_date", "sectors")


def analysed(docs: DataFrame, stem: bool = True, fields: Mapping[str, str] = FIELDS,
             keep: Sequence[str] = FILTERABLE, tasks: int | None = None) -> DataFrame:
    """Index rows ``doc_key, <filter columns>, field, dl, postings``: one row per document field.

    Narrow from end to end: words are sorted inside their row and runs of equal words become
    (term, tf) pairs, so building the index shuffles nothing, however frequent a word is.
    """
    parts = F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(column).alias("body")) for name, column in fields.items()
    ])
    key = ["doc_key", *keep]
    rows = deal_out(docs.select(*key, *fields.values()), tasks).select(*key, F.inline(parts))
    words = french.terms(F.col("body"))
    rows = rows.select(*key, "field", F.sort_array(french.stems(words) if stem else words).alias("_w"))
    rows = rows.withColumn("dl", F.size("_w"))
    places = F.filter(
        F.sequence(F.lit(0), F.col("dl") - 1),
        lambda i: (i == 0) | (F.get(F.col("_w"), i) != F.get(F.col("_w"), i - 1)))
    rows = rows.withColumn("_s", F.when(F.col("dl") > 0, places))
    runs = F.transform("_s", lambda p, j: F.struct(
        F.get(F.col("_w"), p).alias("term"),
        (F.coalesce(F.get(F.col("_s"), j + 1), F.col("dl")) - p).cast("bigint").alias("tf")))
    return rows.select(*key, "field", "dl", runs.alias("postings"))


def analysed_documents(docs: DataFrame, stem: bool = True, keep: Sequence[str] = FILTERABLE, tasks: int | None = None) -> DataFrame:
    """The same with one row per document: ``doc_key, <kept columns>`` and per field ``_dl, _terms, _tfs`` (terms sorted)."""
    rows = deal_out(docs.select("doc_key", *keep, *FIELDS.values()), tasks)
    for name, column in FIELDS.items():
        words = french.terms(F.col(column))
        rows = rows.withColumn(f"_w_{name}", F.sort_array(french.stems(words) if stem else words))
    for name in FIELDS:
        words, dl, starts = F.col(f"_w_{name}"), F.col(f"{name}_dl"), F.col(f"_s_{name}")
        rows = rows.withColumn(f"{name}_dl", F.size(words))
        rows = rows.withColumn(f"_s_{name}", F.when(dl > 0, F.filter(
            F.sequence(F.lit(0), dl - 1), lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))))
        rows = rows.withColumn(f"{name}_terms", F.transform(starts, lambda p: F.get(words, p)))
        rows = rows.withColumn(f"{name}_tfs", F.transform(
            starts, lambda p, j: (F.coalesce(F.get(starts, j + 1), dl) - p).cast("int")))
    return rows.select("doc_key", *keep, *[f"{name}_{c}" for name in FIELDS for c in ("dl", "terms", "tfs")])


def build_index(docs: DataFrame, stem: bool = True, keep: Sequence[str] = FILTERABLE, tasks: int | None = None) -> DataFrame:
    """The index as a written table: texts are read and cut into words once, and every statistic
    and search after that reads only the columns it needs."""
    return written(analysed(docs, stem, keep=keep, tasks=tasks), "index")


def postings(index: DataFrame) -> DataFrame:
    """``doc_key, field, dl, term, tf``."""
    rows = explode_once(index, ["doc_key", "field", "dl"], F.col("postings"), "p")
    return rows.select("doc_key", "field", "dl", "p.term", "p.tf")


def field_stats(index: DataFrame) -> DataFrame:
    """Documents holding the field and their average length, over the whole corpus."""
    return index.filter("dl > 0").groupBy("field").agg(
        F.count("*").alias("n_docs"), F.avg("dl").alias("avg_dl"))


def term_stats(post: DataFrame) -> DataFrame:
    """Document frequency per field and term (a partial count, whatever the frequency)."""
    return post.groupBy("field", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("total_tf"))


def query_terms(queries: DataFrame, stem: bool = True) -> DataFrame:
    """``query_id, term, qtf`` from ``query_id, query``."""
    words = explode_once(queries, ["query_id"], french.terms(F.col("query")), "term")
    if stem:
        words = french.with_stem(words)
    return words.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def term_weight(qtf: Column, df: Column, n: Column) -> Column:
    """Part of BM25 that depends on the query term only."""
    return qtf * F.log(1 + (n - df + 0.5) / (df + 0.5))


def saturation(tf: Column, dl: Column, avg_dl: Column) -> Column:
    """Part of BM25 that depends on the document."""
    return tf / (tf + K1 * (1 - B + B * dl / avg_dl))


def weighted_terms(index: DataFrame, queries: DataFrame, stem: bool = True) -> DataFrame:
    """Query terms with what scoring needs of the whole corpus; terms absent from it drop out.

    Stored twice on the way: as a file, each set has a known size, and by that size Spark itself
    decides whether it may be broadcast to the postings or must be joined by a shuffle (where
    adaptive execution splits the partition of a very frequent word).
    """
    wanted = written(query_terms(queries, stem), "query-terms")
    used = postings(index).join(wanted.select("term").distinct(), "term", "left_semi")
    joined = wanted.join(term_stats(used), "term").join(field_stats(index), "field")
    weight = term_weight(F.col("qtf"), F.col("df"), F.col("n_docs"))
    return written(joined.select("query_id", "field", "term", weight.alias("weight"), "avg_dl"), "weights")


def score_queries(index: DataFrame, queries: DataFrame, filters: SearchFilters | None = None,
                  stem: bool = True) -> DataFrame:
    """``query_id, doc_key, title, text``: BM25 of every matching document, per field.

    Filters are pushed into the scan of the index and never touch the statistics. A document's
    field is one index row, so the partial sums before the shuffle already hold its whole score:
    what is shuffled is one row per (query, document), whatever the number of common words.
    """
    terms = weighted_terms(index, queries, stem)
    scanned = index if filters is None else index.filter(filters.condition())
    return sum_scores(postings(scanned).join(terms, ["field", "term"]))


def sum_scores(matched: DataFrame) -> DataFrame:
    """Field scores per (query, document) of weighted postings."""
    score = F.col("weight") * saturation(F.col("tf"), F.col("dl"), F.col("avg_dl"))
    return matched.groupBy("query_id", "doc_key").agg(*[
        F.sum(F.when(F.col("field") == name, score)).alias(name) for name in FIELDS
    ])


def _best(boost: Column) -> Column:
    """Best field: the larger of weighted title and text, rounded so that the order does not
    depend on the order of additions."""
    return F.round(F.greatest(boost * F.col("title"), F.col("text")), 6)


def best_field(scores: DataFrame, boost: float = TITLE_BOOST) -> DataFrame:
    return scores.select("query_id", "doc_key", _best(F.lit(float(boost))).alias("score"))


def best_field_grid(scores: DataFrame, boosts: Sequence[float]) -> DataFrame:
    """One result set per title weight out of one scoring: the weights are a fixed short array."""
    weights = F.array(*[F.lit(float(b)) for b in boosts])
    return scores.withColumn("title_boost", F.explode(weights)).select(
        "query_id", "title_boost", "doc_key", _best(F.col("title_boost")).alias("score"))


def ranked(hits: DataFrame, k: int = TOP_K, by: list[str] | None = None) -> DataFrame:
    """Top k per query with the exact number of matches beside it.

    The total is a plain count, not a window over all matches of a query, and the rank filter is
    applied per task before the shuffle: a query matching a third of the corpus stays spread.
    """
    by = by or ["query_id"]
    top = top_k_per_group(hits, by, [F.desc("score"), F.col("doc_key")], k)
    totals = hits.groupBy(*by).agg(F.count("score").alias("total_hits"))
    return top.join(totals, by)


def search(index: DataFrame, queries: DataFrame, k: int = TOP_K, boost: float = TITLE_BOOST,
           filters: SearchFilters | None = None, stem: bool = True) -> DataFrame:
    """Ranked documents of every query: ``query_id, doc_key, score, rank, total_hits``."""
    return ranked(best_field(score_queries(index, queries, filters, stem), boost), k)


def by_number(docs: DataFrame, k: int = TOP_K) -> DataFrame:
    """``number_key, doc_key, rank, total_hits``: what a search for each number returns.

    All matches of a number score alike, so its first k keys are the answer. Numbers are ranked
    once, whatever the number of queries: a number shared by very many documents and searched by
    very many queries never multiplies the two.
    """
    numbered = docs.select(fold_keyword(F.col("decision_number")).alias("number_key"), "doc_key").filter(
        F.col("number_key").isNotNull())
    top = top_k_per_group(numbered, ["number_key"], [F.col("doc_key")], k)
    totals = numbered.groupBy("number_key").agg(F.count("*").alias("total_hits"))
    # Both are grouped by number already, and there are as many numbers as documents: no side is sent to every task.
    return top.join(totals.hint("merge"), "number_key")


def exact_number(docs: DataFrame, queries: DataFrame, k: int = TOP_K) -> DataFrame:
    """First k documents whose number equals the query's, both folded."""
    wanted = queries.select("query_id", fold_keyword(F.col("number")).alias("number_key"))
    return wanted.join(by_number(docs, k), "number_key").select(
        "query_id", "doc_key", F.lit(1.0).alias("score"), "rank", "total_hits")


PIECE = rf"(?s){french.TOKEN}|[^\p{{L}}\p{{N}}_]+|."


def reach(size: int) -> int:
    """Characters after a match in which others belong to its fragment; the rest is context on both sides."""
    return 2 * size // 3


def marked_pieces(hits: DataFrame, stem: bool = True) -> DataFrame:
    """Words of the hits' titles and texts and what stands between them, as a written table: ``query_id, doc_key, field, pos,
    begin, fin`` (characters), ``stem`` (of a word the query asks for, else NULL) and ``out`` (escaped, marked if it is one).
    Each distinct word of the page is stemmed once."""
    both = F.array(
        F.struct(F.lit("title").alias("field"), F.col("title").alias("body")),
        F.struct(F.lit("text").alias("field"), F.col("text").alias("body")))
    hits = written(hits.select("query_id", "doc_key", "query", "title", "text"), "hits")
    # Dealt out by document: the running lengths below need no further shuffle.
    tasks = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = hits.select("query_id", "doc_key", "title", "text").repartition(
        tasks, "query_id", "doc_key").select("query_id", "doc_key", F.inline(both)).select(
        "query_id", "doc_key", "field", F.posexplode_outer(F.regexp_extract_all("body", F.lit(PIECE), F.lit(0))).alias("pos", "piece"))
    words = words.withColumn("term", french.term(F.col("piece")))
    wanted = query_terms(hits.select("query_id", "query").distinct(), stem).select(
        "query_id", F.col("term").alias("stem"))
    forms = words.select("term").distinct().withColumn("stem", F.col("term"))
    if stem:
        forms = french.with_stem(forms, "stem")
    marks = forms.join(wanted, "stem").select("query_id", "term", "stem")
    # One document's field is the largest group here, and its pieces are numbered in order.
    so_far = Window.partitionBy("query_id", "doc_key", "field").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    fin = F.sum(F.length("piece")).over(so_far)
    safe = html_escape(F.col("piece"))
    out = F.when(F.col("stem").isNotNull(), F.concat(F.lit("<mark>"), safe, F.lit("</mark>"))).otherwise(safe)
    return written(words.join(marks, ["query_id", "term"], "left").select(
        "query_id", "doc_key", "field", "pos", (fin - F.length("piece")).alias("begin"), fin.alias("fin"), "stem", out.alias("out"),
    ), "pieces")


def best_windows(matches: DataFrame, size: int, count: int) -> DataFrame:
    """``query_id, doc_key, field, position, low, high``: the windows of a text to be shown, best first.

    Every match opens a candidate: the matches that begin within ``reach`` of it, with context on both sides up to ``size``
    characters. Most distinct terms wins, then most matches, then the first; what overlaps a chosen window is out. The rounds are
    windows over one partitioning, that of a document's field.
    """
    key = ["query_id", "doc_key", "field"]
    near = Window.partitionBy(*key).orderBy("begin").rangeBetween(0, reach(size) - 1)
    rows = matches.select(
        *key, "begin", F.size(F.collect_set("stem").over(near)).alias("terms"), F.count("*").over(near).alias("n"),
        F.max("fin").over(near).alias("last"))
    pad = F.greatest(F.lit(0), F.floor((F.lit(size) - (F.col("last") - F.col("begin"))) / 2))
    rows = rows.withColumn("low", F.col("begin") - pad).withColumn("high", F.col("last") + pad).withColumn("position", F.lit(None).cast("int"))
    rows = rows.withColumn("open", F.lit(True))
    order = F.struct("terms", "n", -F.col("begin"), "low", "high")
    for number in range(1, count + 1):
        rows = rows.withColumn("best", F.max(F.when(F.col("open"), order)).over(Window.partitionBy(*key)))
        chosen = F.col("open") & (order == F.col("best"))
        apart = (F.col("low") >= F.col("best.high")) | (F.col("high") <= F.col("best.low"))
        rows = rows.select(
            *key, "begin", "terms", "n", "low", "high", F.when(chosen, number).otherwise(F.col("position")).alias("position"),
            (F.col("open") & apart).alias("open"))
    return rows.filter(F.col("position").isNotNull()).select(*key, "position", "low", "high")


def highlight(hits: DataFrame, stem: bool = True, size: int = FRAGMENT_SIZE, count: int = FRAGMENTS) -> DataFrame:
    """Marked title and text fragments of ``query_id, doc_key, query, title, text`` (the hits of a page only): matching words,
    elided article included, inside <mark>; everything HTML-escaped.

    A text gives at most ``count`` fragments of about ``size`` characters around its matches (``best_windows``), cut at token
    borders; the title is kept whole. ``n_terms`` distinct terms are marked ``n_hits`` times; fields without a match give no row.
    """
    pieces, key = marked_pieces(hits, stem), ["query_id", "doc_key", "field"]
    matches = pieces.filter(F.col("stem").isNotNull())
    titles = matches.filter("field = 'title'").select(*key).distinct().select(
        *key, F.lit(1).alias("position"), F.lit(0).alias("low"), F.lit(None).alias("high"))
    shown = best_windows(matches.filter("field = 'text'"), size, count).unionByName(titles)
    inside = (F.col("begin") >= F.col("low")) & (F.col("high").isNull() | (F.col("fin") <= F.col("high")))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "out")))
    return pieces.join(shown, key).filter(inside).groupBy(*key, "position").agg(
        F.array_join(F.transform(ordered, lambda x: x["out"]), "").alias("html"),
        F.count("stem").alias("n_hits"), F.count_distinct("stem").alias("n_terms"))
