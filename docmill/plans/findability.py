"""Known-item evaluation: can each sampled document be found by its number, by its title?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions.text import is_sql_blank, number_key, title_key
from docmill.operators import aggregates, keys, ranking
from docmill.plans import published, search
from docmill.session import written

KEY = ["source", "external_id"]
FLAGS = ["has_text", "ambiguous_title", "ambiguous_number"]
SAMPLE_SIZE = 200
TITLE_WIDTH = 80


def _sql_number_key() -> Column:
    return F.lower(F.trim("decision_number"))


def sample(silver: DataFrame, titled_source: str, whole_source: str, n: int = SAMPLE_SIZE) -> DataFrame:
    """Reproducible sample: n documents of one source by MD5, its blank texts, every document
    with a shared number, and all of another source."""
    titled = silver.filter(F.col("source") == titled_source)
    picks = [
        ranking.hash_sample(titled.select(*KEY), "external_id", n),
        titled.filter(is_sql_blank(F.col("text"))).select(*KEY),
        keys.with_shared_number(silver.select(*KEY, "decision_number"), _sql_number_key()).select(*KEY),
        silver.filter(F.col("source") == whole_source).select(*KEY),
    ]
    picked = reduce(DataFrame.union, picks).distinct()
    rows = silver.select(
        *KEY, "decision_number", "title", (~is_sql_blank(F.col("text"))).alias("has_text"))
    return rows.join(picked, KEY, "left_semi")


def targets(silver: DataFrame, sampled: DataFrame) -> DataFrame:
    """Sampled documents with ambiguity flags computed over the whole table."""
    title, number = title_key(F.col("title")), number_key(F.col("decision_number"))
    flagged = keys.flag_shared(sampled, title, "ambiguous_title", silver)
    flagged = keys.flag_shared(flagged, number, "ambiguous_number", silver)
    return flagged.withColumn("doc_id", F.concat_ws("|", "source", "external_id"))


def for_mode(rows: DataFrame, mode: str, titled_source: str) -> DataFrame:
    if mode == "number":
        return rows.filter(number_key(F.col("decision_number")).isNotNull())
    if mode == "title":
        return rows.filter(
            (F.col("source") == titled_source) & title_key(F.col("title")).isNotNull())
    raise ValueError(f"unknown mode: {mode}")


def evaluate(silver: DataFrame, rows: DataFrame, titled_source: str, boosts: list[float], index_path: str,
             stem: bool = True, asked: Column | None = None) -> DataFrame:
    """One row per target and evaluation: ``mode, title_boost, doc_id, flags, rank, total_hits``.

    Targets with the same number or the same title ask the same question, which is answered once on the published index,
    for all title weights together, document by document (``docwise``): of what matches, only the first ten of each task leave it. The
    rank is NULL outside the first ten.
    ``asked``: what of a title is searched (all of it by default).

    Targets and number lists are both used twice: stored, they are made once, and what the driver plans for the result reads
    written tables alone.
    """
    docs = silver.withColumn("doc_key", F.concat_ws("|", "source", "external_id"))
    rows = written(rows, "targets")
    numbered = for_mode(rows, "number", titled_source).withColumn(
        "query_id", search.fold_keyword(F.col("decision_number")))
    lists = written(search.by_number(docs).withColumnRenamed("number_key", "query_id"), "numbers")
    totals = lists.groupBy("query_id").agg(F.max("total_hits").alias("total_hits"))
    number_rows = _ranks(numbered, lists, totals, ["query_id"]).withColumn(
        "title_boost", F.lit(None).cast("double"))

    titled = written(for_mode(rows, "title", titled_source).withColumn(
        "query", F.col("title") if asked is None else asked).withColumn("query_id", F.sha2("query", 256)), "titled")
    questions = titled.groupBy("query_id").agg(F.min("query").alias("query"))
    lists, totals = published.search_all(silver.sparkSession, index_path, questions, boosts, stem=stem)
    weights = F.array(*[F.lit(float(b)) for b in boosts])
    title_rows = _ranks(titled.withColumn("title_boost", F.explode(weights)), lists, totals, ["query_id", "title_boost"])

    columns = ["title_boost", "doc_id", "decision_number", "title", *FLAGS, "rank", "total_hits"]
    return number_rows.select(F.lit("number").alias("mode"), *columns).unionByName(
        title_rows.select(F.lit("title").alias("mode"), *columns))


def _ranks(found: DataFrame, lists: DataFrame, totals: DataFrame, by: list[str]) -> DataFrame:
    """Position of each target in the list of its question, and the question's total."""
    # There are as many lists as targets, and of numbers as many as documents: neither side is sent to every task by the driver.
    positions = lists.select(*by, F.col("doc_key").alias("doc_id"), "rank").hint("merge")
    return (
        found.join(positions, [*by, "doc_id"], "left").join(totals.hint("merge"), "query_id", "left")
        .withColumn("total_hits", F.coalesce("total_hits", F.lit(0)))
    )


def metrics(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    by = by or ["mode", "title_boost"]
    return results.groupBy(*by).agg(*aggregates.metric_columns(F.col("rank")))


def group_metrics(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    return aggregates.group_metrics(results, FLAGS, by or ["mode", "title_boost"])


def history(results: DataFrame, run_id: int, first_eval_id: int, index_name: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """Rows to append: one per evaluation with its metrics (NUMERIC(5,4)), one per target with the
    evaluation's id. Evaluations (a mode and title weight each) are numbered in their order."""
    asked = results.select("mode", "title_boost").distinct()
    # A handful of evaluations: this window is over them, not over results.
    numbered = asked.withColumn("eval_id", F.row_number().over(
        Window.orderBy("mode", F.col("title_boost").asc_nulls_first())) + F.lit(first_eval_id - 1))
    same = F.col("r.mode").eqNullSafe(F.col("e.mode")) & F.col("r.title_boost").eqNullSafe(F.col("e.title_boost"))
    rows = results.alias("r").join(numbered.alias("e"), same).select(
        F.col("eval_id").cast("bigint").alias("eval_id"), F.lit(run_id).cast("bigint").alias("run_id"), "r.mode",
        F.col("r.title_boost").cast("decimal(5,2)").alias("title_boost"), "doc_id", *FLAGS,
        F.col("rank").cast("int").alias("rank"), F.col("total_hits").cast("int").alias("total_hits"))
    evals = metrics(rows, ["eval_id", "run_id", "mode", "title_boost"]).withColumns(
        {c: F.round(c, 4).cast("decimal(5,4)") for c in ("hit_at_1", "hit_at_10", "mrr")}
        | {"sample_size": F.col("sample_size").cast("int"), "index_name": F.lit(index_name), "created_at": now})
    return evals, rows


def append_history(evals: DataFrame, rows: DataFrame, root: str) -> None:
    """Rows first: an evaluation is listed only once its targets are stored."""
    rows.write.mode("append").parquet(f"{root}/eval_results")
    evals.write.mode("append").parquet(f"{root}/evals")


def misses(results: DataFrame, evaluations: list[tuple[str, float | None]]) -> DataFrame:
    """Documents absent from the top ten of at least one evaluation, one rank column each."""
    labels = [label(mode, boost) for mode, boost in evaluations]
    name = F.when(F.col("title_boost").isNull(), F.col("mode")).otherwise(
        F.concat(F.col("mode"), F.lit("_"), F.col("title_boost").cast("string")))
    wide = (
        results.withColumn("_eval", name)
        .groupBy("doc_id", "decision_number", "title").pivot("_eval", labels).agg(F.max("rank"))
    )
    missed = reduce(lambda a, b: a | b, [F.col(f"`{x}`").isNull() for x in labels])
    return wide.filter(missed).withColumn("shown_title", shorten(F.col("title")))


def label(mode: str, boost: float | None) -> str:
    return mode if boost is None else f"{mode}_{float(boost)}"


def shorten(title: Column, width: int = TITLE_WIDTH) -> Column:
    from docmill.functions.text import strip

    text = F.coalesce(strip(title), F.lit(""))
    return F.when(F.length(text) <= width, text).otherwise(
        F.concat(F.substring(text, 1, width - 1), F.lit("…")))
