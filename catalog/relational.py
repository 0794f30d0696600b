"""Filters, joins, aggregates, windows, sorts and set operations (FLT, JN, AG, WN, SL, SO)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.payloads import authority_records, court_records
from catalog.projections import REGISTRY, raw_layer
from catalog.registry import query
from catalog.sinks import batch, stored
from catalog.views import AS_OF, TITLED, WHOLE, now, source_table, table
from docmill.functions import text
from docmill.functions.dates import number_year
from docmill.functions.urls import normalize_url
from docmill.model import SEVERITIES, STATUS_ORDER
from docmill.operators import aggregates, filters, keys, ranking
from docmill.plans import findability, publish, quality, reports, silver
from docmill.session import written
from catalog.scalars import strip_sql

START, END = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
RANGE = f"BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
FILTERS = filters.SearchFilters(
    source=["src0", "src3", "src7"], decision_type=["avis", "decision"], sector=["fr", "long"],
    date_from=date(1995, 1, 1), date_to=date(2015, 12, 31))
FILTER_SQL = """source IN ('src0', 'src3', 'src7') AND decision_type IN ('avis', 'decision')
  AND list_has_any(string_split(sectors_text, '|'), ['fr', 'long'])
  AND decision_date >= DATE '1995-01-01' AND decision_date <= DATE '2015-12-31'"""

# Check history: values of every day judged by the engine, used by reads and dashboards too.
CHECKS = [
    quality.Check("low_value", "completeness", "warning", "", {"default": ("<=", 2), "error": ("<=", 4)}),
    quality.Check("high_key", "validity", "error", "", {"default": ("<", 3)}),
    quality.Check("repeated_user", "uniqueness", "warning", "", {"view": ("<=", 20), "ghost": ("==", 0)}),
    quality.Check("zero_key", "consistency", "error", "", {"click": (">=", 1.5)}),
]
EXPECT_SQL = """expect(check_name, dimension, severity, source, op, bound) AS (VALUES
  ('low_value', 'completeness', 'warning', 'default', '<=', '2'), ('low_value', 'completeness', 'warning', 'error', '<=', '4'),
  ('high_key', 'validity', 'error', 'default', '<', '3'), ('repeated_user', 'uniqueness', 'warning', 'view', '<=', '20'),
  ('repeated_user', 'uniqueness', 'warning', 'ghost', '==', '0'), ('zero_key', 'consistency', 'error', 'click', '>=', '1.5'))"""
RESULTS_SQL = f"""{EXPECT_SQL},
  bad AS (SELECT run_id, check_name, 'no value for source ' || min(CASE WHEN value IS NULL THEN source END) AS error
          FROM v_check_values GROUP BY run_id, check_name HAVING count(*) > count(value)),
  sound AS (SELECT v.* FROM v_check_values v WHERE NOT EXISTS (
              SELECT 1 FROM bad WHERE bad.run_id = v.run_id AND bad.check_name = v.check_name)),
  judged AS (SELECT s.run_id, s.check_name, s.source, s.value, coalesce(o.op, d.op) AS op, coalesce(o.bound, d.bound) AS bound
             FROM sound s LEFT JOIN expect o ON o.check_name = s.check_name AND o.source = s.source
               LEFT JOIN expect d ON d.check_name = s.check_name AND d.source = 'default'),
  res0 AS (
    SELECT run_id, check_name, source, CAST(value AS DOUBLE) AS value, op || ' ' || bound AS expected,
      CASE WHEN op IS NULL THEN 'unchecked' WHEN CASE op WHEN '==' THEN value = CAST(bound AS DECIMAL(18,4))
        WHEN '<=' THEN value <= CAST(bound AS DECIMAL(18,4)) WHEN '>=' THEN value >= CAST(bound AS DECIMAL(18,4))
        WHEN '<' THEN value < CAST(bound AS DECIMAL(18,4)) ELSE value > CAST(bound AS DECIMAL(18,4)) END
        THEN 'pass' ELSE 'fail' END AS status, CAST(NULL AS STRING) AS error FROM judged
    UNION ALL
    SELECT r.run_id, e.check_name, e.source, NULL, e.op || ' ' || e.bound, 'no_data', NULL
    FROM (SELECT DISTINCT run_id FROM v_check_values) r CROSS JOIN expect e
    WHERE e.source <> 'default'
      AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.run_id = r.run_id AND bad.check_name = e.check_name)
      AND NOT EXISTS (SELECT 1 FROM sound s WHERE s.run_id = r.run_id AND s.check_name = e.check_name AND s.source = e.source)
    UNION ALL
    SELECT run_id, check_name, NULL, NULL, NULL, 'query_error', error FROM bad),
  results AS (SELECT res0.run_id, res0.check_name, m.dimension, res0.source, res0.value, res0.expected, m.severity,
      res0.status, res0.error, t.checked_at
    FROM res0 JOIN (SELECT DISTINCT check_name, dimension, severity FROM expect) m ON m.check_name = res0.check_name
      JOIN (SELECT DISTINCT run_id, checked_at FROM v_check_values) t ON t.run_id = res0.run_id)"""
BLOCKED = "severity = 'error' AND status IN ('fail', 'no_data', 'query_error')"


def check_results(spark, sf):
    """Judged check history with its moments; the values are stored once for all uses."""
    values = written(table(spark, sf, "v_check_values"), "check-values")
    runs = values.select("run_id", "checked_at").distinct()
    judged = quality.evaluate(
        values.select("run_id", "check_name", "source", "value"), quality.expectations(spark, CHECKS), ["run_id"],
        runs.select("run_id"))
    return judged.join(runs, "run_id")


def shown(df):
    return df.withColumn("value", F.col("value").cast("double"))


# Filters -----------------------------------------------------------------------------------

@query("flt_search_filters", f"SELECT doc_id FROM v_decisions WHERE {FILTER_SQL}")
def flt_search_filters(spark, sf):
    return table(spark, sf, "v_decisions").filter(FILTERS.condition()).select("doc_id")


@query("flt_optional_params", "SELECT run_id, source, status FROM v_runs WHERE source IN ('click', 'error')")
def flt_optional_params(spark, sf):
    kept = filters.optional(table(spark, sf, "v_runs"), source=["click", "error"], status=None)
    return kept.select("run_id", "source", "status")


@query("flt_three_valued", """
SELECT doc_id FROM v_decisions
WHERE (text IS NULL OR trim(text, ' ') = '') AND NOT (source = 'src0' AND decision_date > DATE '2010-01-01')
""")
def flt_three_valued(spark, sf):
    recent = (F.col("source") == TITLED) & (F.col("decision_date") > F.lit("2010-01-01").cast("date"))
    return table(spark, sf, "v_decisions").filter(text.is_sql_blank(F.col("text")) & ~recent).select("doc_id")


@query("flt_regex", r"SELECT doc_id, decision_number FROM v_decisions WHERE regexp_matches(decision_number, '^\d{2}-')")
def flt_regex(spark, sf):
    rows = table(spark, sf, "v_decisions")
    return rows.filter(F.col("decision_number").rlike(r"^\d{2}-")).select("doc_id", "decision_number")


@query("flt_time_range", f"SELECT run_id, started_at FROM v_runs WHERE started_at {RANGE}")
def flt_time_range(spark, sf):
    return filters.time_range(table(spark, sf, "v_runs"), "started_at", START, END).select("run_id", "started_at")


@query("flt_results_not_verdict", f"""
WITH {RESULTS_SQL}, v AS (SELECT run_id, CASE WHEN bool_or({BLOCKED}) THEN 'failure' ELSE 'success' END AS verdict
  FROM results GROUP BY run_id)
SELECT results.run_id, check_name, source, status, verdict FROM results JOIN v ON v.run_id = results.run_id
WHERE status = 'pass'
""")
def flt_results_not_verdict(spark, sf):
    """Only passing results are listed, the verdict still rests on all of them."""
    results = check_results(spark, sf)
    verdicts = aggregates.verdict(results, ["run_id"]).select("run_id", "verdict")
    return results.filter(F.col("status") == "pass").join(verdicts, "run_id").select(
        "run_id", "check_name", "source", "status", "verdict")


@query("flt_targets_mode", f"""
SELECT 'number' AS mode, doc_id FROM v_decisions WHERE nullif(lower(trim(decision_number, ' ')), '') IS NOT NULL
UNION ALL
SELECT 'title', doc_id FROM v_decisions WHERE source = '{TITLED}' AND nullif({strip_sql('title')}, '') IS NOT NULL
""")
def flt_targets_mode(spark, sf):
    rows = table(spark, sf, "v_decisions")
    parts = [findability.for_mode(rows, m, TITLED).select(F.lit(m).alias("mode"), "doc_id") for m in ("number", "title")]
    return parts[0].unionByName(parts[1])


# Joins -------------------------------------------------------------------------------------

@query("jn_left_unmatched", """
SELECT b.source, count(CASE WHEN s.external_id IS NULL THEN 1 END) AS value
FROM (SELECT DISTINCT source, external_id FROM v_batch) b
LEFT JOIN v_stored s ON s.source = b.source AND s.external_id = b.external_id GROUP BY b.source
""")
def jn_left_unmatched(spark, sf):
    incoming = table(spark, sf, "v_batch").select("source", "external_id").distinct()
    return quality.rows_missing_downstream(incoming, table(spark, sf, "v_stored"))


@query("jn_full_outer_diff", """
SELECT source, coalesce(s.n, 0) - coalesce(i.n, 0) AS value
FROM (SELECT lang AS source, count(*) AS n FROM documents GROUP BY lang) s
FULL OUTER JOIN (SELECT regexp_extract(url, 'example[.][a-z]+/([a-z]+)/', 1) AS source, count(*) AS n FROM pages
  GROUP BY 1) i USING (source)
""")
def jn_full_outer_diff(spark, sf):
    left = source_table(spark, sf, "documents").groupBy(F.col("lang").alias("source")).agg(F.count("*").alias("n"))
    site = F.regexp_extract("url", "example[.][a-z]+/([a-z]+)/", 1)
    right = source_table(spark, sf, "pages").groupBy(site.alias("source")).agg(F.count("*").alias("n"))
    return keys.count_difference(left, right)


def listing_and_dataset(spark, sf):
    """Pages of the site, and the addresses the dataset knows: http pages under another form."""
    listed = table(spark, sf, "v_listing")
    known = source_table(spark, sf, "pages").filter(F.col("url").startswith("http:")).select(
        F.concat(F.lit(" "), F.rtrim("url", F.lit("/")), F.lit("// ")).alias("external_id"))
    return listed, known


_KNOWN = "SELECT rtrim(url, '/') FROM pages WHERE url LIKE 'http:%'"


@query("jn_anti_normalized", f"SELECT page_id, url FROM v_listing WHERE rtrim(url, '/') NOT IN ({_KNOWN})")
def jn_anti_normalized(spark, sf):
    listed, known = listing_and_dataset(spark, sf)
    return keys.missing_rows(listed, known, normalize_url(F.col("url")), normalize_url(F.col("external_id"))).select(
        "page_id", "url")


@query("jn_find_missing", f"""
SELECT page_id, title, row_number() OVER (PARTITION BY CAST(floor(page_id / 20) AS BIGINT) ORDER BY page_id) AS position
FROM v_listing WHERE rtrim(url, '/') NOT IN ({_KNOWN})
""")
def jn_find_missing(spark, sf):
    """Missing items in the order of their listing page."""
    from pyspark.sql import Window

    listed, known = listing_and_dataset(spark, sf)
    missing = keys.missing_rows(listed, known, normalize_url(F.col("url")), normalize_url(F.col("external_id")))
    order = Window.partitionBy(F.floor(F.col("page_id") / 20)).orderBy("page_id")
    return missing.select("page_id", "title", F.row_number().over(order).alias("position"))


@query("jn_inner_using", """
SELECT source, external_id, d.decision_number, l.quality FROM v_decisions d
JOIN (SELECT CAST(doc_id AS STRING) AS external_id, quality FROM labels) l USING (external_id)
""")
def jn_inner_using(spark, sf):
    picked = source_table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("external_id"), "quality")
    return table(spark, sf, "v_decisions").join(picked, "external_id").select(
        "source", "external_id", "decision_number", "quality")


@query("jn_semi_having", """
SELECT doc_id FROM v_decisions WHERE lower(trim(decision_number, ' ')) IN (
  SELECT lower(trim(decision_number, ' ')) FROM v_decisions WHERE decision_number IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
""")
def jn_semi_having(spark, sf):
    rows = table(spark, sf, "v_decisions").select("doc_id", "decision_number")
    return keys.with_shared_number(rows, F.lower(F.trim("decision_number"))).select("doc_id")


@query("jn_scalar_max", "SELECT source, indexed_count FROM v_index_stats WHERE run_id = (SELECT max(run_id) FROM v_index_stats WHERE alias_switched)")
def jn_scalar_max(spark, sf):
    stats = table(spark, sf, "v_index_stats")
    last = stats.filter("alias_switched").agg(F.max("run_id")).scalar()
    return stats.filter(F.col("run_id") == last).select("source", "indexed_count")


@query("jn_results_runs", """
SELECT f.result_id, f.rank, r.sample_size, r.hit_at_1 FROM v_eval_results f JOIN v_evals r ON r.eval_id = f.eval_id
""")
def jn_results_runs(spark, sf):
    evals = table(spark, sf, "v_evals").select("eval_id", "sample_size", "hit_at_1")
    return table(spark, sf, "v_eval_results").select("eval_id", "result_id", "rank").join(evals, "eval_id").drop("eval_id")


@query("jn_lateral_unpivot", """
SELECT eval_id, name, value FROM v_evals, LATERAL (VALUES ('hit@1', hit_at_1), ('hit@10', hit_at_10), ('MRR', mrr)) AS m(name, value)
""")
def jn_lateral_unpivot(spark, sf):
    evals = table(spark, sf, "v_evals").select(
        "eval_id", F.col("hit_at_1").alias("hit@1"), F.col("hit_at_10").alias("hit@10"), F.col("mrr").alias("MRR"))
    return evals.unpivot(["eval_id"], ["hit@1", "hit@10", "MRR"], "name", "value")


@query("jn_declared_absent", f"""
WITH {RESULTS_SQL} SELECT run_id, check_name, source, expected FROM results WHERE status = 'no_data'
""")
def jn_declared_absent(spark, sf):
    return check_results(spark, sf).filter(F.col("status") == "no_data").select("run_id", "check_name", "source", "expected")


@query("jn_default_fallback", f"""
WITH {RESULTS_SQL} SELECT run_id, check_name, source, expected FROM results WHERE status IN ('pass', 'fail', 'unchecked')
""")
def jn_default_fallback(spark, sf):
    rows = check_results(spark, sf).filter(F.col("status").isin("pass", "fail", "unchecked"))
    return rows.select("run_id", "check_name", "source", "expected")


@query("jn_three_way_sources", """
SELECT source, coalesce(a.n, 0) AS stored, coalesce(b.n, 0) AS indexed, coalesce(c.n, 0) AS rejected
FROM (SELECT o_orderpriority AS source, count(*) AS n FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1) a
FULL OUTER JOIN (SELECT o_orderpriority AS source, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) b USING (source)
FULL OUTER JOIN (SELECT c_mktsegment AS source, count(*) AS n FROM customer GROUP BY 1) c USING (source)
""")
def jn_three_way_sources(spark, sf):
    orders = source_table(spark, sf, "orders").withColumn("source", F.col("o_orderpriority"))
    customers = source_table(spark, sf, "customer").withColumn("source", F.col("c_mktsegment"))
    count = lambda df: df.groupBy("source").agg(F.count("*").alias("n"))
    return keys.merge_counts({
        "stored": count(orders.filter("source <> '1-URGENT'")),
        "indexed": count(orders.filter("o_orderstatus = 'F'")), "rejected": count(customers)})


# Aggregates --------------------------------------------------------------------------------

@query("ag_count_filter", "SELECT source, count(CASE WHEN decision_date IS NULL THEN 1 END) AS value FROM v_decisions GROUP BY source")
def ag_count_filter(spark, sf):
    return aggregates.count_where(table(spark, sf, "v_decisions"), F.col("decision_date").isNull())


@query("ag_percentage", """
SELECT source, CAST(round(100.0 * count(CASE WHEN decision_type IS NULL THEN 1 END) / count(*), 2) AS DOUBLE) AS value
FROM v_decisions GROUP BY source
""")
def ag_percentage(spark, sf):
    return shown(aggregates.percent_where(table(spark, sf, "v_decisions"), F.col("decision_type").isNull()))


@query("ag_duplicate_groups", """
SELECT 'all' AS source, count(*) AS value FROM (SELECT decision_number FROM v_decisions WHERE decision_number IS NOT NULL
  GROUP BY 1 HAVING count(*) > 1) d
""")
def ag_duplicate_groups(spark, sf):
    return aggregates.duplicate_groups(table(spark, sf, "v_decisions"), F.col("decision_number"), "all")


_TITLE_KEY = f"nullif(replace({strip_sql('title')}, '’', ''''), '')"


@query("ag_ambiguous_keys", f"""
SELECT md5({_TITLE_KEY}) AS title, count(*) AS n FROM v_decisions WHERE {_TITLE_KEY} IS NOT NULL
GROUP BY {_TITLE_KEY} HAVING count(*) > 1
""")
def ag_ambiguous_keys(spark, sf):
    return keys.shared_keys(table(spark, sf, "v_decisions"), text.title_key(F.col("title"))).select(
        F.md5("key").alias("title"), "n")


@query("ag_freshness", f"""
SELECT source, max(finished_at) AS last_end,
  round(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(finished_at)) AS DOUBLE) / 1000000 / 3600) + 0.0 AS hours
FROM v_runs WHERE status = 'success' GROUP BY source
""")
def ag_freshness(spark, sf):
    done = table(spark, sf, "v_runs").filter(F.col("status") == "success")
    last = done.groupBy("source").agg(F.max("finished_at").alias("last_end"))
    return last.join(quality.hours_since_success(table(spark, sf, "v_runs"), now()), "source").withColumnRenamed(
        "value", "hours")


STEPS = ["click", "error", "purchase", "signup", "view", "ghost"]
_WIDE = ", ".join(
    f"round(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(finished_at) FILTER (WHERE source = '{s}')) AS DOUBLE)"
    f" / 1000000 / 3600, 1) + 0.0 AS {s}" for s in STEPS)


@query("ag_conditional_pivot", f"SELECT {_WIDE} FROM v_runs WHERE status = 'success'")
def ag_conditional_pivot(spark, sf):
    done = table(spark, sf, "v_runs").filter(F.col("status") == "success")
    return aggregates.hours_since_wide(done, "finished_at", now(), STEPS)


@query("ag_bool_share", """
SELECT eval_id, avg(CASE WHEN rank = 1 THEN 1.0 ELSE 0.0 END) AS share FROM v_eval_results GROUP BY eval_id
""")
def ag_bool_share(spark, sf):
    return table(spark, sf, "v_eval_results").groupBy("eval_id").agg(
        aggregates.true_share(F.col("rank") == 1).alias("share"))


METRICS_SQL = """count(*) AS sample_size, avg(CASE WHEN rank = 1 THEN 1.0 ELSE 0.0 END) AS hit_at_1,
  avg(CASE WHEN rank IS NOT NULL THEN 1.0 ELSE 0.0 END) AS hit_at_10, avg(coalesce(CAST(1 AS DOUBLE) / rank, 0)) AS mrr"""


@query("ag_retrieval_metrics", f"SELECT eval_id, mode, title_boost, {METRICS_SQL} FROM v_eval_results GROUP BY ALL")
def ag_retrieval_metrics(spark, sf):
    return findability.metrics(table(spark, sf, "v_eval_results"), ["eval_id", "mode", "title_boost"])


@query("ag_group_metrics", f"""
WITH g AS (SELECT eval_id, rank, unnest(['has_text', 'ambiguous_title', 'ambiguous_number']) AS "group",
    unnest([has_text, ambiguous_title, ambiguous_number]) AS value FROM v_eval_results),
  grid AS (SELECT eval_id, f AS "group", b AS value FROM (SELECT DISTINCT eval_id FROM v_eval_results),
    (VALUES ('has_text'), ('ambiguous_title'), ('ambiguous_number')) x(f), (VALUES (TRUE), (FALSE)) y(b)),
  m AS (SELECT eval_id, "group", value, {METRICS_SQL} FROM g GROUP BY eval_id, "group", value)
SELECT eval_id, "group", value, coalesce(sample_size, 0) AS sample_size, hit_at_1, hit_at_10, mrr
FROM grid LEFT JOIN m USING (eval_id, "group", value)
""")
def ag_group_metrics(spark, sf):
    return aggregates.group_metrics(table(spark, sf, "v_eval_results"), findability.FLAGS, ["eval_id"])


@query("ag_count_by_source", "SELECT source, count(*) AS n FROM v_decisions GROUP BY source")
def ag_count_by_source(spark, sf):
    return table(spark, sf, "v_decisions").groupBy("source").agg(F.count("*").alias("n"))


_STATUS_COLUMNS = ", ".join(f"count(CASE WHEN status = '{s}' THEN 1 END) AS n_{s}" for s in STATUS_ORDER)


@query("ag_status_counts", f"WITH {RESULTS_SQL} SELECT run_id, {_STATUS_COLUMNS} FROM results GROUP BY run_id")
def ag_status_counts(spark, sf):
    return aggregates.status_counts(check_results(spark, sf), ["run_id"])


@query("ag_distinct_list", "SELECT DISTINCT source FROM v_runs WHERE source IN ('click', 'view', 'ghost')")
def ag_distinct_list(spark, sf):
    return reports.pick_list(table(spark, sf, "v_runs"), "source", F.col("source").isin("click", "view", "ghost"))


@query("ag_verdict", f"""
WITH {RESULTS_SQL} SELECT run_id, CASE WHEN bool_or({BLOCKED}) THEN 'failure' ELSE 'success' END AS verdict,
  count(CASE WHEN {BLOCKED} THEN 1 END) AS n_blocking FROM results GROUP BY run_id
""")
def ag_verdict(spark, sf):
    return aggregates.verdict(check_results(spark, sf), ["run_id"])


# Windows -----------------------------------------------------------------------------------

@query("wn_rank_topk", """
SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) x WHERE rank <= 10
""")
def wn_rank_topk(spark, sf):
    orders = source_table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ranking.top_k_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 10).drop(
        "o_totalprice")


@query("wn_latest_row", """
SELECT source, run_id, status FROM v_runs r WHERE run_id = (SELECT max(run_id) FROM v_runs m WHERE m.source = r.source)
""")
def wn_latest_row(spark, sf):
    runs = table(spark, sf, "v_runs").select("source", "run_id", "status")
    return ranking.latest_row(runs, ["source"], [F.desc("run_id")])


_NUMBER_KEY = "nullif(lower(trim(decision_number, ' ')), '')"


@query("wn_ambiguous_flag", f"""
SELECT doc_id, {_TITLE_KEY} IS NOT NULL AND count(*) OVER (PARTITION BY {_TITLE_KEY}) > 1 AS ambiguous_title,
  {_NUMBER_KEY} IS NOT NULL AND count(*) OVER (PARTITION BY {_NUMBER_KEY}) > 1 AS ambiguous_number FROM v_decisions
""")
def wn_ambiguous_flag(spark, sf):
    rows = table(spark, sf, "v_decisions").select("source", "external_id", "title", "decision_number")
    return findability.targets(rows, rows).select(
        F.col("external_id").cast("bigint").alias("doc_id"), "ambiguous_title", "ambiguous_number")


# Sorts and limits --------------------------------------------------------------------------

@query("sl_hash_sample", "SELECT source, external_id FROM v_decisions ORDER BY md5(external_id), external_id LIMIT 200")
def sl_hash_sample(spark, sf):
    return ranking.hash_sample(table(spark, sf, "v_decisions").select("source", "external_id"), "external_id", 200)


@query("sl_top10", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10")
def sl_top10(spark, sf):
    lines = source_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ranking.page(lines, [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 1, 10)


@query("sl_pagination", """
SELECT doc_id, n_chars, (SELECT count(*) FROM documents) AS total FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 40
""")
def sl_pagination(spark, sf):
    docs = source_table(spark, sf, "documents").select("doc_id", "n_chars")
    total = docs.agg(F.count("*")).scalar()
    return ranking.page(docs, [F.desc("n_chars"), F.col("doc_id")], 3, 20).withColumn("total", total)


@query("sl_latest_runs", "SELECT run_id, source, status FROM v_runs WHERE status = 'failed' ORDER BY run_id DESC LIMIT 20")
def sl_latest_runs(spark, sf):
    return reports.latest_runs(table(spark, sf, "v_runs"), 20, status="failed").select("run_id", "source", "status")


_RANKS = (f"list_position({list(STATUS_ORDER)}, status), list_position({list(SEVERITIES)}, severity), check_name, "
          "coalesce(source, '')")


@query("sl_report_order", f"""
WITH {RESULTS_SQL} SELECT run_id, check_name, source, status, row_number() OVER (PARTITION BY run_id ORDER BY {_RANKS}) AS position
FROM results
""")
def sl_report_order(spark, sf):
    from pyspark.sql import Window

    order = Window.partitionBy("run_id").orderBy(*ranking.report_order())
    return check_results(spark, sf).select(
        "run_id", "check_name", "source", "status", F.row_number().over(order).alias("position"))


# Set operations ----------------------------------------------------------------------------

# Each document once, with what it could be picked for.
SAMPLE_SQL = f"""reasons AS (
    SELECT source, external_id, row_number() OVER (PARTITION BY source ORDER BY md5(external_id), external_id) AS place,
      length(trim(coalesce(text, ''), ' ')) = 0 AS blank,
      decision_number IS NOT NULL AND count(*) OVER (PARTITION BY lower(trim(decision_number, ' '))) > 1 AS shares_number
    FROM v_decisions),
  picked AS (SELECT DISTINCT source, external_id FROM reasons
    WHERE shares_number OR source = '{WHOLE}' OR (source = '{TITLED}' AND (blank OR place <= 200)))"""


@query("so_union_distinct", f"WITH {SAMPLE_SQL} SELECT * FROM picked")
def so_union_distinct(spark, sf):
    return findability.sample(table(spark, sf, "v_decisions"), TITLED, WHOLE).select("source", "external_id")


def series_sql(check: str) -> str:
    """Value and threshold of each result as a list of labelled points, taken apart."""
    return f"""
WITH {RESULTS_SQL},
  points AS (SELECT checked_at, source, unnest(list_filter([
      {{'label': 'valeur', 'shown': TRUE, 'level': CAST(value AS DOUBLE)}},
      {{'label': 'attendu (' || split_part(expected, ' ', 1) || ')', 'shown': expected IS NOT NULL,
        'level': CAST(regexp_extract(expected, '-?[0-9]+(?:\\.[0-9]+)?', 0) AS DOUBLE)}}], lambda p: p.shown)) AS point
    FROM results WHERE check_name = '{check}' AND source IS NOT NULL AND checked_at {RANGE})
SELECT checked_at AS time, concat_ws(' : ', source, point.label) AS metric, point.level AS value FROM points
"""


@query("so_union_all_series", series_sql("low_value"))
def so_union_all_series(spark, sf):
    """Both series as a plain union of two selections."""
    kept = filters.time_range(check_results(spark, sf).filter(
        (F.col("check_name") == "low_value") & F.col("source").isNotNull()), "checked_at", START, END)
    measured = kept.select(F.col("checked_at").alias("time"), F.concat("source", F.lit(" : valeur")).alias("metric"),
                           F.col("value").cast("double").alias("value"))
    expected = kept.filter(F.col("expected").isNotNull()).select(
        F.col("checked_at").alias("time"),
        F.concat("source", F.lit(" : attendu ("), text.expectation_operator(F.col("expected")), F.lit(")")).alias("metric"),
        text.expectation_bound(F.col("expected")).cast("double").alias("value"))
    return measured.unionByName(expected)


@query("so_silver_union", """
SELECT source, count(*) AS n FROM (
  SELECT 'authority' AS source FROM part WHERE p_size <> 50 UNION ALL SELECT 'court' FROM customer WHERE c_nationkey <> 24) x
GROUP BY source
""")
def so_silver_union(spark, sf):
    rows = silver.silver_rows(silver.transform_all(raw_layer(spark, sf), REGISTRY), now())
    return rows.groupBy("source").agg(F.count("*").alias("n"))


__all__ = ["authority_records", "batch", "court_records", "number_year", "publish", "stored"]
