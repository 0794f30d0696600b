"""A published search index: built once, gated by counts per source like any version, read by every search.

Documents are numbered without gaps. Beside the postings stand what lets a search leave most of them unread:

* ``terms`` holds, per term and field, the document frequency and the largest saturation of any document: times the query's
  weight it bounds what the term can add to a score (``bounded``).
* ``members``: for terms that at least one document in COMMON_SHARE holds, bitmaps of their documents, so totals are counted
  without scoring. There are at most COMMON_SHARE times the words of a mean document of such terms.
* ``forward`` holds each document's terms in one row, for searches that match much of the corpus (``docwise``). These need no postings:
  an index may be published without, and ``write_postings`` makes them of this table when a search asks for them.

Every table of terms is partitioned by the hash of the term and sorted by term, postings also partitioned by ranges of documents: a search
reads the folders and row groups of its terms, however many terms it has. Postings are lists, a row per term, field and slice of documents;
a search joins them with its terms first and opens those it asked for.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.operators.filters import SearchFilters
from docmill.operators.layout import deal_out
from docmill.operators.ranking import top_k_per_group
from docmill.plans import docwise, publish, search
from docmill.session import written

POSTINGS, TERMS, FIELDS, DOCUMENTS, MEMBERS, FORWARD = "postings", "terms", "fields", "documents", "members", "forward"
#: Folders by term, documents of a part at least and parts at most (parts are whole numbers of bitmaps).
SLOTS, PART_DOCS, PARTS = 16, 1 << 17, 64
BITMAP_DOCS = 32768
LISTS = "term string, field string, docs array<bigint>, tfs array<int>, dls array<int>, part int"
COMMON_SHARE = 32


def slot(term: Column | str) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(SLOTS)).cast("int")


def _numbered(forward: DataFrame) -> DataFrame:
    """Rows of the forward table with ``doc_no`` in place of ``row_id``: 0 to n - 1, by the task that numbered them."""
    task = F.shiftright("row_id", 33)
    per_task = forward.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    # One row per task of the numbering: this window is over tasks, not over documents.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(per_task.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "numbers")
    low = F.col("row_id").bitwiseAND(F.lit((1 << 33) - 1))
    return forward.withColumn("_task", task).join(starts, "_task").withColumn("doc_no", F.col("_start") + low).drop("_task", "_start", "row_id")


def _field_postings(documents: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep, field, dl, term, tf`` out of rows with one array of terms per field. A field reads its own columns alone."""
    parts = []
    for name in search.FIELDS:
        rows = documents.select(*keep, F.lit(name).alias("field"), F.col(f"{name}_dl").alias("dl"), F.inline_outer(
            F.arrays_zip(F.col(f"{name}_terms").alias("term"), F.col(f"{name}_tfs").alias("tf"))))
        parts.append(rows.filter(F.col("term").isNotNull()).withColumn("tf", F.col("tf").cast("bigint")))
    return reduce(DataFrame.unionByName, parts)


def write_index(docs: DataFrame, path: str, stem: bool = True, tasks: int | None = None, part_docs: int | None = None,
                postings: bool = True) -> None:
    """Write the index of documents (``doc_key, source, title, text`` and the filter columns).

    ``tasks``: over how many tasks a table of few splits is dealt out before its texts are cut into words. Without ``postings`` it
    serves searches document by document, and ``write_postings`` adds them."""
    spark = docs.sparkSession
    filters = list(search.FILTERABLE)
    rows = deal_out(docs.select("doc_key", *filters, "title", "text"), tasks).withColumn("row_id", F.monotonically_increasing_id())
    search.analysed_documents(rows, stem, keep=[*filters, "row_id"]).write.parquet(f"{path}/{FORWARD}")
    forward = _read(spark, path, FORWARD)
    _numbered(forward.select("row_id", "doc_key", *filters)).select("doc_no", "doc_key", *filters).write.parquet(f"{path}/{DOCUMENTS}")
    lengths = forward.select(F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_dl").alias("dl")) for f in search.FIELDS])))
    search.field_stats(lengths).write.parquet(f"{path}/{FIELDS}")
    top = F.max(search.saturation(F.col("tf"), F.col("dl"), F.col("avg_dl")))
    stats = _field_postings(forward, []).join(F.broadcast(_read(spark, path, FIELDS)), "field").groupBy("term", "field").agg(  # a row per field
        F.count("*").alias("df"), F.sum("tf").alias("total_tf"), top.alias("top"))
    _by_slot(stats.withColumn("slot", slot("term")), f"{path}/{TERMS}")
    if postings:
        write_postings(spark, path, part_docs)


def inverted(part_docs: int):
    """Turns documents into lists: of each slice of documents, part and field one row per term with its documents, frequencies and
    lengths, so that a common word's postings are shuffled and stored as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_no = batch.column("doc_no").to_numpy()
            for name in search.FIELDS:
                terms, tfs = batch.column(f"{name}_terms"), batch.column(f"{name}_tfs")
                words = terms.flatten().dictionary_encode()
                if not len(words):
                    continue
                row = np.repeat(np.arange(batch.num_rows), np.diff(terms.offsets.to_numpy()))
                doc, width = doc_no[row], len(words.dictionary)
                code = doc // part_docs * width + words.indices.to_numpy()
                order = np.argsort(code, kind="stable")
                kinds, first = np.unique(code[order], return_index=True)
                ends = pa.array(np.append(first, len(order)).astype(np.int32))
                dl = batch.column(f"{name}_dl").to_numpy(zero_copy_only=False)[row]
                arrays = [pa.ListArray.from_arrays(ends, x.take(order)) for x in (pa.array(doc), tfs.flatten(), pa.array(dl.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays([
                    words.dictionary.take(pa.array(kinds % width)), pa.array([name] * len(kinds), pa.string()), *arrays,
                    pa.array((kinds // width).astype(np.int32))], [c.split()[0] for c in LISTS.split(", ")])

    return run


def entries(lists: DataFrame, *keep: str) -> DataFrame:
    """``keep, doc_no, tf, dl``: one row per posting of some lists."""
    columns = [F.col(c).alias(alias) for c, alias in (("docs", "doc_no"), ("tfs", "tf"), ("dls", "dl"))]
    return lists.select(*keep, F.inline_outer(F.arrays_zip(*columns)))  # no list is empty


def _documents_of(lists: DataFrame, *keep: str) -> DataFrame:
    return lists.select(*keep, F.explode_outer("docs").alias("doc_no"))


def allowed(spark: SparkSession, path: str, posts: DataFrame, filters: SearchFilters | None) -> DataFrame:
    """Postings of the documents that pass the filters."""
    if filters is None:
        return posts
    return posts.join(documents_read(spark, path).filter(filters.condition()).select("doc_no"), "doc_no", "left_semi")


def write_postings(spark: SparkSession, path: str, part_docs: int | None = None) -> None:
    """Postings and bitmaps of an index, made of its documents' terms. What a failed call left is written anew."""
    if part_docs is None:
        n = documents_read(spark, path).count()
        part_docs = max(PART_DOCS, -(-n // (PARTS * BITMAP_DOCS)) * BITMAP_DOCS)
    forward = _numbered(_read(spark, path, FORWARD)).select("doc_no", *[f"{f}_{c}" for f in search.FIELDS for c in ("dl", "terms", "tfs")])
    lists = forward.mapInArrow(inverted(part_docs), LISTS).withColumn("slot", slot("term"))
    # A folder's lists are as many as its documents' terms, by a bounded number of documents: they meet in one task.
    lists = lists.repartition("slot", "part").sortWithinPartitions("slot", "part", "term", "field")
    lists.write.mode("overwrite").partitionBy("slot", "part").parquet(f"{path}/{POSTINGS}")
    stored = _read(spark, path, POSTINGS)
    n_docs = F.broadcast(_read(spark, path, DOCUMENTS).agg(F.count("*").alias("_all")))  # one row
    common = written(_read(spark, path, TERMS).groupBy("slot", "term").agg(F.max("df").alias("_df")).join(
        n_docs, F.col("_df") * COMMON_SHARE >= F.col("_all")).select("slot", "term"), "common")
    _by_slot(_bitmaps(_documents_of(stored.join(common, ["slot", "term"]), "slot", "term"), ["slot", "term"]), f"{path}/{MEMBERS}")


def _by_slot(rows: DataFrame, path: str) -> None:
    rows.repartitionByRange("slot", "term").sortWithinPartitions("slot", "term").write.mode("overwrite").partitionBy("slot").parquet(path)


def _bitmaps(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by, bucket, bits``: the documents of rows as bitmaps of BITMAP_DOCS documents."""
    bucket, place = F.bitmap_bucket_number("doc_no"), F.bitmap_bit_position("doc_no")
    return rows.select(*by, bucket.alias("bucket"), place.alias("_place")).groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_place").alias("bits"))


#: Columns of the tables, so that no footer is read to find them out.
SCHEMAS = {
    POSTINGS: LISTS.replace("part int", "slot int, part int"),
    TERMS: "term string, field string, df bigint, total_tf bigint, top double, slot int",
    FIELDS: "field string, n_docs bigint, avg_dl double",
    DOCUMENTS: "doc_no bigint, doc_key string, source string, decision_type string, decision_date date, sectors array<string>",
    MEMBERS: "term string, bucket bigint, bits binary, slot int",
    FORWARD: "doc_key string, source string, decision_type string, decision_date date, sectors array<string>, row_id bigint, "
             "title_dl int, title_terms array<string>, title_tfs array<int>, text_dl int, text_terms array<string>, text_tfs array<int>",
}


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}")


def documents_read(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, DOCUMENTS)


def rebuild_index(docs: DataFrame, expected: DataFrame, rejected: DataFrame, root: str, dataset: str, version: str,
                  now: Column, stem: bool = True, tasks: int | None = None, postings: bool = True) -> DataFrame:
    """Build, count, gate and publish; a refused index is deleted. Returns the gate rows with the outcome."""
    spark, path = docs.sparkSession, f"{root}/{version}"
    write_index(docs, path, stem, tasks, postings=postings)
    indexed = documents_read(spark, path).groupBy("source").agg(F.count("*").alias("n"))
    rows = written(publish.gate_rows(expected, indexed, rejected), "gate")
    outcome = publish.gate(rows).first()
    if outcome["publish"]:
        publish.publish(spark, f"{root}/versions", dataset, version, path, now)
    else:
        publish.discard(spark, path)
    return rows.withColumn("published", F.lit(bool(outcome["publish"]))).withColumn("reason", F.lit(outcome["reason"]).cast("string"))


class Terms:
    """The terms of some queries against an index: their weights, and the condition that finds their rows in its tables."""

    def __init__(self, spark: SparkSession, path: str, wanted: DataFrame):
        self.spark, self.path = spark, path
        self.wanted = wanted.select("query_id", "term", "qtf", slot("term").alias("slot"))
        edges = self.wanted.groupBy("slot").agg(F.min("term").alias("low"), F.max("term").alias("high")).collect()  # SLOTS rows at most
        self.where = F.lit(False)
        for r in sorted(edges):
            self.where = self.where | ((F.col("slot") == r["slot"]) & F.col("term").between(r["low"], r["high"]))
        weight = search.term_weight(F.col("qtf"), F.col("df"), F.col("n_docs"))
        self.weights = written(
            self.wanted.join(self.read(TERMS), ["slot", "term"]).join(_read(spark, path, FIELDS), "field")
            .select("query_id", "slot", "field", "term", weight.alias("weight"), "avg_dl", "df", (weight * F.col("top")).alias("most")), "weights")

    def read(self, name: str) -> DataFrame:
        return _read(self.spark, self.path, name).filter(self.where)

    def totals(self, filters: SearchFilters | None = None) -> DataFrame:
        """``query_id, total_hits``: documents holding any term of the query (and passing the filters), from bitmaps alone.

        Terms without stored bitmaps are in less than one document in COMMON_SHARE; theirs are made of their postings.
        """
        dense = self.read(MEMBERS).join(self.wanted.select("query_id", "slot", "term"), ["slot", "term"]).select("query_id", "bucket", "bits")
        common = self.read(MEMBERS).select("slot", "term").distinct()
        rare = self.wanted.select("query_id", "slot", "term").join(common, ["slot", "term"], "left_anti")
        posts = _documents_of(self.read(POSTINGS).select("slot", "term", "docs").join(rare, ["slot", "term"]), "query_id")
        any_term = dense.unionByName(_bitmaps(posts, ["query_id"])).groupBy("query_id", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        if filters is not None:
            passing = _bitmaps(documents_read(self.spark, self.path).filter(filters.condition()), []).withColumnRenamed("bits", "_allowed")
            both = any_term.join(passing, "bucket").select("query_id", "bucket", F.explode(F.array("bits", "_allowed")).alias("bits"))
            any_term = both.groupBy("query_id", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"))
        return any_term.groupBy("query_id").agg(F.sum(F.bitmap_count("bits")).alias("total_hits")).filter("total_hits > 0")


def matches(spark: SparkSession, path: str, wanted: DataFrame, filters: SearchFilters | None = None) -> DataFrame:
    """Postings of the wanted terms (``query_id, term, qtf``) with their weights."""
    terms = Terms(spark, path, wanted)
    lists = terms.read(POSTINGS).join(terms.weights, ["slot", "field", "term"])
    return allowed(spark, path, entries(lists, *terms.weights.columns), filters)


def search_index(spark: SparkSession, path: str, queries: DataFrame, k: int = search.TOP_K, boost: float = search.TITLE_BOOST,
                 filters: SearchFilters | None = None, stem: bool = True) -> DataFrame:
    """Ranked documents of every query, as ``search.search`` gives them: all matches scored, so their count is the total."""
    return search_grid(spark, path, queries, [boost], k, filters, stem).drop("title_boost")


def search_grid(spark: SparkSession, path: str, queries: DataFrame, boosts: Sequence[float], k: int = search.TOP_K,
                filters: SearchFilters | None = None, stem: bool = True) -> DataFrame:
    """The same for several title weights (``title_boost``) out of one scoring."""
    first, totals = search_all(spark, path, queries, boosts, k, filters, stem)
    return first.join(totals, "query_id")


def search_all(spark: SparkSession, path: str, queries: DataFrame, boosts: Sequence[float], k: int = search.TOP_K,
               filters: SearchFilters | None = None, stem: bool = True) -> tuple[DataFrame, DataFrame]:
    """``query_id, title_boost, doc_key, score, rank`` and ``query_id, total_hits``, document by document (``docwise``)."""
    wanted, fields = written(search.query_terms(queries, stem), "query-terms"), _read(spark, path, FIELDS)
    # Queries can be many and long: no side of this join is sent to every task.
    known = wanted.hint("merge").join(_read(spark, path, TERMS).select("term", "field", "df"), "term").join(F.broadcast(fields), "field")
    weights = written(known.select(
        "query_id", "field", "term", search.term_weight(F.col("qtf"), F.col("df"), F.col("n_docs")).alias("weight")), "weights")
    found = docwise.search_documents(spark, _read(spark, path, FORWARD), fields, weights, boosts, k, filters)
    kind = queries.schema["query_id"].dataType
    first, totals = (rows.withColumn("query_id", F.col("query_id").cast(kind)) for rows in found)
    return first, totals
