"""Run log and incremental windows (RL), and reads (RD)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.projections import DISPLAY
from catalog.registry import query
from catalog.relational import BLOCKED, RESULTS_SQL, _RANKS, _STATUS_COLUMNS, check_results, shown
from catalog.sinks import HASH, RUN, batch, stored
from catalog.views import AS_OF_DATE, now, source_table, table, today
from docmill.operators import upsert
from docmill.plans import reports, runs
from docmill.session import written



@query("rl_run_collapse", """
SELECT run_id, source, date_type, date_start, date_end, started_at, finished_at,
  CASE WHEN finished_at IS NULL THEN 'running' ELSE status END AS status,
  CASE WHEN finished_at IS NULL THEN 0 ELSE nb_fetched END AS nb_fetched,
  CASE WHEN finished_at IS NULL THEN 0 ELSE nb_new END AS nb_new,
  CASE WHEN finished_at IS NULL THEN 0 ELSE nb_changed END AS nb_changed,
  CASE WHEN status = 'failed' THEN repeat(error, 90) END AS error FROM v_runs
""")
def rl_run_collapse(spark, sf):
    """Start and finish events of every run, folded back into one row each."""
    log = table(spark, sf, "v_runs")
    none = lambda t: F.lit(None).cast(t)
    start = log.select("run_id", F.lit("start").alias("event"), F.col("started_at").alias("at"), "source", "date_type",
                       "date_start", "date_end", none("string").alias("status"), none("int").alias("nb_fetched"),
                       none("int").alias("nb_new"), none("int").alias("nb_changed"), none("string").alias("error"))
    finish = log.filter(F.col("finished_at").isNotNull()).select(
        "run_id", F.lit("finish").alias("event"), F.col("finished_at").alias("at"), none("string").alias("source"),
        none("string").alias("date_type"), none("date").alias("date_start"), none("date").alias("date_end"), "status",
        "nb_fetched", "nb_new", "nb_changed", F.repeat(F.col("error"), F.lit(90)).alias("error"))
    return runs.collapse(start.unionByName(finish))


_LAST_SQL = """SELECT source, date_type, max(date_end) AS last_end FROM v_runs
WHERE status = 'success' AND date_type IS NOT NULL GROUP BY source, date_type"""


@query("rl_last_successful_end", _LAST_SQL)
def rl_last_successful_end(spark, sf):
    return runs.last_successful_end(table(spark, sf, "v_runs"))


@query("rl_compute_window", f"""
WITH l AS ({_LAST_SQL}),
  k AS (SELECT DISTINCT source, coalesce(date_type, 'never') AS date_type,
    CASE WHEN source = 'view' THEN DATE '2024-01-15' END AS asked FROM v_runs)
SELECT k.source, k.date_type, coalesce(asked, last_end + 1 - 14, DATE '{AS_OF_DATE}' - 7) AS window_start,
  DATE '{AS_OF_DATE}' AS window_end, coalesce(asked, last_end + 1, DATE '{AS_OF_DATE}' - 7) AS start_without_overlap,
  coalesce(asked, last_end + 1, DATE '{AS_OF_DATE}' - 7) > DATE '{AS_OF_DATE}' AS nothing_to_do
FROM k LEFT JOIN l ON l.source = k.source AND l.date_type = k.date_type
""")
def rl_compute_window(spark, sf):
    """Windows per source and date type: an explicit start, a resumed one, or none before."""
    log = table(spark, sf, "v_runs")
    asked = F.when(F.col("source") == "view", F.lit("2024-01-15").cast("date"))
    wanted = log.select("source", F.coalesce("date_type", F.lit("never")).alias("date_type")).distinct()
    rows = wanted.join(runs.last_successful_end(log), ["source", "date_type"], "left")
    since, until = runs.window(F.col("last_end"), today(), start=asked)
    tight, _ = runs.window(F.col("last_end"), today(), lookback=0, start=asked)
    return rows.select("source", "date_type", since.alias("window_start"), until.alias("window_end"),
                       tight.alias("start_without_overlap"), (tight > until).alias("nothing_to_do"))


@query("rl_overlap_idempotent", f"""
SELECT source, count(*) AS fetched, 0 AS new, 0 AS changed, count(*) AS unchanged, 0 AS quarantined, 0 AS missing_id
FROM (SELECT source, external_id, arg_max({HASH}, seq) FROM v_batch GROUP BY source, external_id) x GROUP BY source
""")
def rl_overlap_idempotent(spark, sf):
    """The stored table after a batch, and the last version of every record read once more."""
    # Read once, for its hashes: it needs no storing.
    after = upsert.upsert(stored(spark, sf), batch(spark, sf), RUN, now())
    again = upsert.last_hashes(batch(spark, sf)).withColumn("seq", F.lit(1).cast("bigint"))
    return upsert.ingest_counts(upsert.sequential_status(after, again), ["source"])


@query("rd_decision_lookup", f"""
SELECT source, external_id, decision_number, md5(text) AS text, regexp_matches(text, '[^\\s]') AS has_text,
  {DISPLAY} AS display_title FROM v_decisions WHERE external_id IN (SELECT CAST(doc_id AS STRING) FROM labels WHERE toxic = 1)
""")
def rd_decision_lookup(spark, sf):
    docs = table(spark, sf, "v_decisions")
    wanted = source_table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("external_id"))
    keyed = docs.select("source", "external_id").join(wanted, "external_id")
    return reports.decision_lookup(docs, keyed).select(
        "source", "external_id", "decision_number", F.md5("text").alias("text"), "has_text", "display_title")


@query("rd_runs", """
SELECT run_id, source, date_type, date_start, date_end, started_at, finished_at, status, nb_fetched, nb_new, nb_changed, error
FROM v_runs WHERE source IN ('view', 'click') ORDER BY run_id DESC LIMIT 50
""")
def rd_runs(spark, sf):
    return reports.latest_runs(table(spark, sf, "v_runs"), 50, sources=["view", "click"])


@query("rd_quality_latest", f"""
WITH {RESULTS_SQL} SELECT check_name, dimension, severity, source, value, expected, status, error, checked_at,
  row_number() OVER (ORDER BY {_RANKS}) AS position FROM results WHERE run_id = (SELECT max(run_id) FROM results)
""")
def rd_quality_latest(spark, sf):
    from pyspark.sql import Window

    latest = reports.latest_quality(written(check_results(spark, sf), "history"))
    order = Window.partitionBy("run_id").orderBy(*reports.ranking.report_order())
    return shown(latest).withColumn("position", F.row_number().over(order)).drop("run_id")


@query("rd_quality_summary", f"""
WITH {RESULTS_SQL} SELECT run_id, {_STATUS_COLUMNS}, CASE WHEN bool_or({BLOCKED}) THEN 'failure' ELSE 'success' END AS verdict,
  count(CASE WHEN {BLOCKED} THEN 1 END) AS n_blocking FROM results GROUP BY run_id
""")
def rd_quality_summary(spark, sf):
    return reports.quality_summary(written(check_results(spark, sf), "history"))
