"""Read side: search page, lookups, run and quality reads, dashboard series and tables.

Every function is a lazy plan over the history tables; time bounds and sources are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.dates import elapsed_seconds
from docmill.functions.display import display_title
from docmill.functions.text import expectation_bound, expectation_operator, has_text, number_label
from docmill.functions.urls import detail_path
from docmill.operators import aggregates, filters, ranking
from docmill.plans import published, search
from docmill.session import written

DAY = "dd/MM/yyyy"
# Labels of the dashboards.
DASH = "—"
VALUE_LABEL, EXPECTED_LABEL = " : valeur", " : attendu ("
AMBIGUOUS, UNAMBIGUOUS = "titre ambigu", "titre non ambigu"
WITH_TEXT, WITHOUT_TEXT = "avec texte", "sans texte"
YES, NO = "oui", "non"
STATE_LEVELS = {"pass": 0, "unchecked": 1, "no_data": 2, "fail": 3, "query_error": 4}


def _duration() -> Column:
    return elapsed_seconds(F.col("finished_at"), F.col("started_at"))


# Reads behind the service ------------------------------------------------------------------

def hit_fields(docs: DataFrame) -> DataFrame:
    """What a search result shows: never the text nor the attributes."""
    return docs.select(
        "source", "external_id", "decision_number", "issuer", "decision_type", "decision_date", "title",
        display_title(F.col("title"), F.col("issuer"), F.col("decision_date"), F.col("decision_number"),
                      F.col("external_id")).alias("display_title"),
        F.coalesce("sectors", F.array().cast("array<string>")).alias("sectors"),
        "url", F.coalesce("has_text", F.lit(False)).alias("has_text"),
        detail_path(F.col("source"), F.col("external_id")).alias("detail_path"),
    )


def search_documents(docs: DataFrame) -> DataFrame:
    """Display fields of every document as a written table with its key: what pages are read from.
    Texts are looked at once, here."""
    rows = hit_fields(docs).withColumn("doc_key", F.concat_ws("|", "source", "external_id"))
    return written(rows, "search-documents")


def search_page(shown: DataFrame, index: DataFrame | str, queries: DataFrame, number: int, size: int, **how) -> DataFrame:
    """One page of every query, ranked as deep as the page needs; the page's rows are stored before
    the display fields of ``search_documents`` join them. ``index``: the path of a published index, or the
    rows of one built for the occasion."""
    depth = ranking.page_end(number, size)
    if isinstance(index, str):
        found = published.search_index(queries.sparkSession, index, queries, depth, **how)
    else:
        found = search.search(index, queries, depth, **how)
    rows = written(ranking.page_per_group(found, number, size), "page")
    return rows.join(shown, "doc_key")


def number_page(shown: DataFrame, docs: DataFrame, queries: DataFrame, number: int, size: int) -> DataFrame:
    """The same page of searches by decision number (``query_id, number``)."""
    found = search.exact_number(docs, queries, ranking.page_end(number, size))
    return ranking.page_per_group(found, number, size).join(shown, "doc_key")


def highlighted(page: DataFrame, texts: DataFrame, queries: DataFrame, stem: bool = True, **fragments) -> DataFrame:
    """Marked titles and fragments of a page's hits; only their texts are fetched, by key."""
    hits = written(page.select("query_id", "doc_key"), "hits")
    bodies = texts.join(hits.select("doc_key").distinct(), "doc_key", "left_semi").select("doc_key", "title", "text")
    return search.highlight(hits.join(bodies, "doc_key").join(queries, "query_id"), stem, **fragments)


def with_highlights(page: DataFrame, texts: DataFrame, queries: DataFrame, stem: bool = True, **fragments) -> DataFrame:
    """A result page with ``title_html`` (NULL where no word of the title is asked for) and ``fragments``, best first."""
    page = written(page, "page")
    marked = highlighted(page, texts, queries, stem, **fragments)
    of_text = F.array_sort(F.collect_list(F.when(F.col("field") == "text", F.struct("position", "html"))))
    by_hit = marked.groupBy("query_id", "doc_key").agg(
        F.max(F.when(F.col("field") == "title", F.col("html"))).alias("title_html"),
        F.transform(of_text, lambda x: x["html"]).alias("fragments"))
    return page.join(by_hit, ["query_id", "doc_key"], "left").withColumn(
        "fragments", F.coalesce("fragments", F.array().cast("array<string>")))


def decision_lookup(silver: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents by exact key (nothing trimmed), with display title and text flag."""
    rows = silver.join(wanted.select("source", "external_id").distinct(),
                       ["source", "external_id"], "left_semi")
    return rows.withColumn("has_text", has_text(F.col("text"))).withColumn(
        "display_title",
        display_title(F.col("title"), F.col("issuer"), F.col("decision_date"), F.col("decision_number"),
                      F.col("external_id")))


def latest_runs(runs: DataFrame, limit: int, sources: list[str] | None = None,
                status: str | None = None) -> DataFrame:
    return filters.optional(runs, source=sources, status=status).orderBy(F.desc("run_id")).limit(limit)


def latest_quality(results: DataFrame) -> DataFrame:
    """Results of the latest run (a scalar subquery, pushed to the scan)."""
    latest = results.agg(F.max("run_id").alias("m")).scalar()
    return results.filter(F.col("run_id") == latest)


def quality_summary(results: DataFrame) -> DataFrame:
    """Counts per status and verdict of each run, over all its results whatever is displayed."""
    counts = aggregates.status_counts(results, ["run_id"])
    return counts.join(aggregates.verdict(results, ["run_id"]), "run_id")


# Pipeline health ---------------------------------------------------------------------------

def last_status(runs: DataFrame, source: str) -> DataFrame:
    kept = runs.filter((F.col("source") == source) & (F.col("status") != "skipped"))
    return kept.orderBy(F.desc("run_id")).limit(1).select("status")


def last_run_detail(runs: DataFrame, source: str) -> DataFrame:
    kept = runs.filter((F.col("source") == source) & (F.col("status") != "skipped"))
    return kept.orderBy(F.desc("run_id")).limit(1).select(
        "run_id", "date_type", "started_at", _duration().alias("duration"), "status", "error")


def run_durations(runs: DataFrame, source: str, start: str, end: str) -> DataFrame:
    kept = runs.filter((F.col("source") == source) & F.col("status").isin("success", "failed"))
    return filters.time_range(kept, "started_at", start, end).select(
        F.col("started_at").alias("time"), F.col("status").alias("metric"), _duration().alias("value"))


def hours_wide(runs: DataFrame, now: Column, sources: list[str]) -> DataFrame:
    done = runs.filter((F.col("status") == "success") & F.col("source").isin(*sources))
    return aggregates.hours_since_wide(done, "finished_at", now, sources)


def run_history(runs: DataFrame, source: str, start: str, end: str) -> DataFrame:
    kept = filters.time_range(runs.filter(F.col("source") == source), "started_at", start, end)
    return kept.orderBy(F.desc("run_id")).select(
        "run_id", "started_at", "date_type", "status", _duration().alias("duration"), "error")


# Collection --------------------------------------------------------------------------------

def volumes_by_run(runs: DataFrame, source: str, start: str, end: str) -> DataFrame:
    kept = runs.filter((F.col("source") == source) & (F.col("status") != "running"))
    return filters.time_range(kept, "started_at", start, end).select(
        F.col("started_at").alias("time"), "nb_fetched", "nb_new", "nb_changed")


def new_changed(runs: DataFrame, sources: list[str], start: str, end: str) -> DataFrame:
    kept = runs.filter(F.col("source").isin(*sources) & (F.col("status") != "running"))
    return filters.time_range(kept, "started_at", start, end).select(
        F.col("started_at").alias("time"), F.col("source").alias("metric"),
        (F.col("nb_new") + F.col("nb_changed")).alias("value"))


def collection_runs(runs: DataFrame, sources: list[str], start: str, end: str) -> DataFrame:
    kept = filters.time_range(runs.filter(F.col("source").isin(*sources)), "started_at", start, end)
    return kept.orderBy(F.desc("run_id")).select(
        "run_id", "source", "started_at", "date_type",
        F.date_format("date_start", DAY).alias("date_from"), F.date_format("date_end", DAY).alias("date_to"),
        "status", _duration().alias("duration"), "nb_fetched", "nb_new", "nb_changed", "error")


# Quality -----------------------------------------------------------------------------------

def state_timeline(results: DataFrame, checks: list[str], start: str, end: str) -> DataFrame:
    level = None
    for status, value in STATE_LEVELS.items():
        hit = F.col("status") == status
        level = F.when(hit, value) if level is None else level.when(hit, value)
    kept = filters.time_range(results.filter(F.col("check_name").isin(*checks)), "checked_at", start, end)
    return kept.select(
        F.col("checked_at").alias("time"),
        F.concat(F.col("check_name"), F.lit(" / "), F.coalesce("source", F.lit(DASH))).alias("metric"),
        level.alias("value"))


def last_deviations(results: DataFrame) -> DataFrame:
    return latest_quality(results).filter(F.col("status") != "pass").select(
        "check_name", "source", "dimension", "severity", "status", "value", "expected", "error")


def value_threshold(results: DataFrame, check: str, start: str, end: str) -> DataFrame:
    """Value series and threshold series of one check: both come from one scan of the history."""
    kept = filters.time_range(
        results.filter((F.col("check_name") == check) & F.col("source").isNotNull()), "checked_at", start, end)
    measured = F.struct(
        F.concat(F.col("source"), F.lit(VALUE_LABEL)).alias("metric"),
        F.col("value").cast("decimal(38,10)").alias("value"))
    expected = F.struct(
        F.concat(F.col("source"), F.lit(EXPECTED_LABEL), expectation_operator(F.col("expected")), F.lit(")"))
        .alias("metric"),
        expectation_bound(F.col("expected")).alias("value"))
    series = F.when(F.col("expected").isNull(), F.array(measured)).otherwise(F.array(measured, expected))
    return kept.select(F.col("checked_at").alias("time"), F.inline(series))


# Search ------------------------------------------------------------------------------------

def indexed_counts(stats: DataFrame, start: str, end: str) -> DataFrame:
    return filters.time_range(stats.filter("alias_switched"), "created_at", start, end).select(
        F.col("created_at").alias("time"), F.col("source").alias("metric"),
        F.col("indexed_count").alias("value"))


def rebuilds(stats: DataFrame, start: str, end: str) -> DataFrame:
    return filters.time_range(stats, "created_at", start, end).orderBy(
        F.desc("run_id"), F.desc("source")).select(
        "run_id", "created_at", "index_name", "source", "silver_count", "indexed_count", "rejected_count",
        F.when(F.col("alias_switched"), YES).otherwise(NO).alias("switched"))


def findability_number(evals: DataFrame, start: str, end: str) -> DataFrame:
    return filters.time_range(evals.filter(F.col("mode") == "number"), "created_at", start, end).select(
        F.col("created_at").alias("time"), "hit_at_1", "hit_at_10", "mrr")


def findability_title(evals: DataFrame, start: str, end: str) -> DataFrame:
    """Metric by title weight in long form: three columns of a row become three rows."""
    kept = filters.time_range(evals.filter(F.col("mode") == "title"), "created_at", start, end)
    names = {"hit@1": "hit_at_1", "hit@10": "hit_at_10", "MRR": "mrr"}
    long = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("value")) for n, c in names.items()])
    label = number_label(F.col("title_boost").cast("decimal(5,2)"))
    return kept.select("created_at", label.alias("weight"), F.inline(long)).select(
        F.col("created_at").alias("time"),
        F.concat(F.col("name"), F.lit(" (poids "), "weight", F.lit(")")).alias("metric"), "value")


def hit1_by_group(results: DataFrame, evals: DataFrame, start: str, end: str, boost: float = 2) -> DataFrame:
    """hit@1 per evaluation for ambiguous and other titles, with and without text."""
    kept = filters.time_range(
        evals.filter((F.col("mode") == "title") & (F.col("title_boost") == boost)), "created_at", start, end)
    rows = results.select("eval_id", "rank", "ambiguous_title", "has_text").join(
        kept.select("eval_id", "created_at"), "eval_id")
    groups = F.array(
        F.when(F.col("ambiguous_title"), AMBIGUOUS).otherwise(UNAMBIGUOUS),
        F.when(F.col("has_text"), WITH_TEXT).otherwise(WITHOUT_TEXT))
    return (
        rows.select(F.col("created_at").alias("time"), "rank", F.explode(groups).alias("metric"))
        .groupBy("time", "metric").agg(aggregates.true_share(F.col("rank") == 1).alias("value"))
    )


def pick_list(df: DataFrame, column: str, condition: Column | None = None) -> DataFrame:
    kept = df if condition is None else df.filter(condition)
    return kept.select(column).distinct().orderBy(column)
