"""Quality engine (QE)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import checks as dq
from catalog.registry import query
from catalog.relational import BLOCKED, EXPECT_SQL, RESULTS_SQL, check_results, listing_and_dataset, shown
from catalog.views import AS_OF, AS_OF_DATE, TITLED, now, table, today
from docmill.functions.urls import normalize_url
from docmill.operators import aggregates
from docmill.plans import quality
from docmill.session import work_dir, written

RESULT_COLUMNS = "run_id, check_name, dimension, source, value, expected, severity, status, error"
_OPS = {"==": "=", "<=": "<=", ">=": ">=", "<": "<", ">": ">"}


@query("qe_operators", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{op}' AS op, CAST(l_extendedprice AS DECIMAL(18,2)) {sql} "
    f"CAST(l_quantity * 1000 AS DECIMAL(18,4)) AS holds FROM lineitem" for op, sql in _OPS.items()))
def qe_operators(spark, sf):
    """Prices against bounds of another scale: 100 equals 100.00."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("v"),
        (F.col("l_quantity") * 1000).cast("decimal(18,4)").alias("b"),
        F.explode(F.array(*[F.lit(op) for op in quality.OPERATORS])).alias("op"))
    return lines.select(
        "l_orderkey", "l_linenumber", "op", quality.holds(F.col("v"), F.col("op"), F.col("b")).alias("holds"))


@query("qe_validate_rows", """
WITH v AS (SELECT run_id, check_name, source, value FROM v_check_values
    UNION ALL SELECT run_id, 'blank_source', CASE WHEN source = 'view' THEN ' ' ELSE source END, value FROM v_check_values
      WHERE check_name = 'low_value'
    UNION ALL SELECT run_id, 'twice', source, value FROM v_check_values WHERE check_name IN ('low_value', 'high_key'))
SELECT run_id, check_name, CASE WHEN count(CASE WHEN trim(source, ' ') = '' THEN 1 END) > 0 THEN 'blank source name'
  WHEN count(value) < count(*) THEN 'no value for source ' || min(CASE WHEN value IS NULL THEN source END)
  ELSE 'several rows for source ' || min(source) END AS error
FROM v GROUP BY run_id, check_name
HAVING count(CASE WHEN trim(source, ' ') = '' THEN 1 END) > 0 OR count(value) < count(*) OR count(*) > count(DISTINCT source)
""")
def qe_validate_rows(spark, sf):
    values = table(spark, sf, "v_check_values").select("run_id", "check_name", "source", "value")
    low = values.filter(F.col("check_name") == "low_value")
    blank = low.withColumn("check_name", F.lit("blank_source")).withColumn(
        "source", F.when(F.col("source") == "view", " ").otherwise(F.col("source")))
    twice = values.filter(F.col("check_name").isin("low_value", "high_key")).withColumn("check_name", F.lit("twice"))
    return quality.row_problems(values.unionByName(blank).unionByName(twice), ["run_id"])


@query("qe_evaluate", f"WITH {RESULTS_SQL} SELECT {RESULT_COLUMNS} FROM results")
def qe_evaluate(spark, sf):
    return shown(check_results(spark, sf).drop("checked_at"))


# Checks as user SQL; the last three cannot give a value and must not stop the others.
SQL_CHECKS = [
    quality.Check("missing_date", "completeness", "error",
                  "SELECT source, count(*) FILTER (WHERE decision_date IS NULL) AS value FROM {decisions} GROUP BY source",
                  {"default": ("<=", 1), "src0": ("==", 0), "ghost": ("==", 0)}),
    quality.Check("no_such_column", "validity", "error", "SELECT source, nothing AS value FROM {decisions}",
                  {"default": ("==", 0)}),
    quality.Check("wrong_columns", "validity", "warning", "SELECT source, 1 AS n FROM {decisions}", {"default": ("==", 0)}),
    quality.Check("fails_at_run_time", "validity", "warning",
                  "SELECT source, sum(CAST(title AS INT)) AS value FROM {decisions} GROUP BY source", {"default": ("==", 0)}),
]


@query("qe_query_error", """
WITH v AS (SELECT source, count(CASE WHEN decision_date IS NULL THEN 1 END) AS value FROM v_decisions GROUP BY source)
SELECT 'missing_date' AS check_name, source, CAST(value AS DOUBLE) AS value,
  CASE WHEN source = 'src0' THEN CASE WHEN value = 0 THEN 'pass' ELSE 'fail' END
    WHEN value <= 1 THEN 'pass' ELSE 'fail' END AS status FROM v
UNION ALL SELECT 'missing_date', 'ghost', NULL, 'no_data'
UNION ALL SELECT unnest(['no_such_column', 'wrong_columns', 'fails_at_run_time']), NULL, NULL, 'query_error'
""")
def qe_query_error(spark, sf):
    results = quality.run_checks(spark, SQL_CHECKS, {"decisions": table(spark, sf, "v_decisions")})
    return shown(results).select("check_name", "source", "value", "status")


@query("qe_verdict", f"""
WITH {RESULTS_SQL} SELECT run_id, CASE WHEN bool_or({BLOCKED}) THEN 'failure' ELSE 'success' END AS verdict,
  count(CASE WHEN {BLOCKED} THEN 1 END) AS n_blocking FROM results GROUP BY run_id
""")
def qe_verdict(spark, sf):
    return aggregates.verdict(check_results(spark, sf), ["run_id"])


@query("qe_history", f"""
WITH {RESULTS_SQL} SELECT 1 AS run_id, check_name, count(*) AS n, TIMESTAMP '{AS_OF}' AS checked_at FROM results GROUP BY check_name
UNION ALL SELECT 2, check_name, count(*), TIMESTAMP '{AS_OF}' FROM results GROUP BY check_name
""")
def qe_history(spark, sf):
    """Two runs appended to one history, read back."""
    results = written(check_results(spark, sf).drop("run_id", "checked_at"), "results")
    path = work_dir(spark, "history")
    for run_id in (1, 2):
        quality.append_history(results, run_id, now(), path)
    return spark.read.parquet(path).groupBy("run_id", "check_name", "checked_at").agg(F.count("*").alias("n"))


SUITE = [
    quality.Check("rows_missing_downstream", "completeness", "error", "", {"F": ("==", 0), "O": ("==", 0)}),
    quality.Check("missing_decision_date", "completeness", "error", "", {"default": ("==", 0)}),
    quality.Check("missing_decision_type_pct", "completeness", "warning", "", {"default": ("==", 0), "src1": ("==", 20)}),
    quality.Check("empty_text", "completeness", "warning", "", {"default": ("==", 0), "src0": ("<=", 25)}),
    quality.Check("index_completeness", "completeness", "error", "", {"default": ("==", 0), "click": ("==", 0)}),
    quality.Check("impossible_decision_date", "validity", "error", "", {"default": ("==", 0)}),
    quality.Check("findability_by_number", "validity", "error", "", {"search": ("==", 1)}),
    quality.Check("findability_by_title", "validity", "warning", "", {"search": (">=", 0.98)}),
    quality.Check("duplicate_number", "uniqueness", "warning", "", {"src0": ("<=", 5)}),
    quality.Check("duplicate_json_key", "uniqueness", "warning", "", {"src1": ("==", 0)}),
    quality.Check("number_year_mismatch", "consistency", "warning", "", {"src0": ("<=", 3)}),
    quality.Check("hours_since_success", "freshness", "warning", "",
                  {"click": ("<=", 168), "error": ("<=", 168), "view": ("<=", 20), "ghost": ("<=", 168)}),
    quality.Check("missing_from_dataset", "freshness", "warning", "", {"site": ("==", 0)}),
]
_SUITE_EXPECT = ", ".join(
    f"('{c.name}', '{c.dimension}', '{c.severity}', '{s}', '{op}', '{b}')" for c in SUITE for s, (op, b) in c.expect.items())
_SUITE_SQL = f"""
  expect(check_name, dimension, severity, source, op, bound) AS (VALUES {_SUITE_EXPECT}),
  vals AS (
    SELECT 'rows_missing_downstream' AS check_name, source, CAST(value AS DOUBLE) AS value FROM (
      SELECT b.source, count(CASE WHEN s.external_id IS NULL THEN 1 END) AS value FROM v_batch b
      LEFT JOIN v_stored s ON s.source = b.source AND s.external_id = b.external_id GROUP BY b.source) a
    UNION ALL SELECT 'missing_decision_date', source, count(*) - count(decision_date) FROM v_decisions GROUP BY source
    UNION ALL SELECT 'missing_decision_type_pct', source, round(100.0 * (count(*) - count(decision_type)) / count(*), 2)
      FROM v_decisions GROUP BY source
    UNION ALL SELECT 'empty_text', source, {dq.EMPTY_SQL} FROM v_decisions GROUP BY source
    UNION ALL SELECT 'index_completeness', source, coalesce(s.n, 0) - coalesce(i.indexed_count, 0)
      FROM (SELECT source, count(*) AS n FROM v_runs GROUP BY source) s FULL OUTER JOIN (SELECT source, indexed_count FROM v_index_stats
        WHERE run_id = (SELECT max(run_id) FROM v_index_stats WHERE alias_switched)) i USING (source)
    UNION ALL SELECT 'impossible_decision_date', source, {dq.IMPOSSIBLE_SQL} FROM v_decisions GROUP BY source
    UNION ALL SELECT 'findability_by_number', source, value FROM (SELECT 'search' AS source, hit_at_10 AS value FROM v_evals
      WHERE mode = 'number' ORDER BY run_id DESC LIMIT 1) b
    UNION ALL SELECT 'findability_by_title', source, value FROM ({dq.FIND_TITLE_SQL}) c
    UNION ALL SELECT 'duplicate_number', '{TITLED}', count(*) FROM (SELECT decision_number FROM v_decisions
      WHERE source = '{TITLED}' AND decision_number IS NOT NULL GROUP BY decision_number HAVING count(*) > 1) d
    UNION ALL SELECT 'duplicate_json_key', 'src1', count(*) FROM (SELECT json_extract_string(attributes, '$.ecli') AS k FROM v_decisions
      WHERE source = 'src1' AND json_extract_string(attributes, '$.ecli') IS NOT NULL GROUP BY 1 HAVING count(*) > 1) e
    UNION ALL SELECT 'number_year_mismatch', source, value FROM ({dq.YEAR_SQL}) f
    UNION ALL SELECT 'hours_since_success', source, value FROM ({dq.HOURS_SQL}) g
    UNION ALL SELECT 'missing_from_dataset', source, value FROM ({dq.MISSING_SQL}) h),
  judged AS (SELECT v.check_name, v.source, v.value, coalesce(o.op, d.op) AS op, coalesce(o.bound, d.bound) AS bound
    FROM vals v LEFT JOIN expect o ON o.check_name = v.check_name AND o.source = v.source
      LEFT JOIN expect d ON d.check_name = v.check_name AND d.source = 'default'),
  res AS (
    SELECT check_name, source, value, op || ' ' || bound AS expected,
      CASE WHEN op IS NULL THEN 'unchecked' WHEN CASE op WHEN '==' THEN value = CAST(bound AS DOUBLE)
        WHEN '<=' THEN value <= CAST(bound AS DOUBLE) ELSE value >= CAST(bound AS DOUBLE) END THEN 'pass' ELSE 'fail' END AS status
    FROM judged
    UNION ALL SELECT check_name, source, NULL, op || ' ' || bound, 'no_data' FROM expect e WHERE source <> 'default'
      AND NOT EXISTS (SELECT 1 FROM vals v WHERE v.check_name = e.check_name AND v.source = e.source))
"""


@query("qe_suite", f"""
WITH {_SUITE_SQL}
SELECT res.check_name, m.dimension, res.source, res.value, res.expected, m.severity, res.status
FROM res JOIN (SELECT DISTINCT check_name, dimension, severity FROM expect) m ON m.check_name = res.check_name
""")
def qe_suite(spark, sf):
    """The thirteen checks as one plan, judged against their expectations."""
    docs, runs = table(spark, sf, "v_decisions"), table(spark, sf, "v_runs")
    evals, results = table(spark, sf, "v_evals"), table(spark, sf, "v_eval_results")
    listed, known = listing_and_dataset(spark, sf)
    values = quality.suite_values({
        "rows_missing_downstream": quality.rows_missing_downstream(
            table(spark, sf, "v_batch"), table(spark, sf, "v_stored")),
        "index_completeness": quality.index_completeness(runs, table(spark, sf, "v_index_stats")),
        "findability_by_number": quality.findability_number(evals),
        "findability_by_title": quality.findability_title(evals, results),
        "duplicate_number": quality.duplicate_number(docs, TITLED),
        "duplicate_json_key": quality.duplicate_json_key(docs, "src1", "$.ecli"),
        "number_year_mismatch": quality.number_year_mismatch(docs, TITLED),
        "hours_since_success": quality.hours_since_success(runs, now(), ["click", "error", "view"]),
        "missing_from_dataset": quality.missing_from_dataset(
            listed, known, normalize_url(F.col("url")), normalize_url(F.col("external_id")), "site"),
    }).unionByName(quality.silver_counts_one_pass(docs, TITLED, dq.FOUNDED, today()))
    # A handful of rows per check, stored once: judging them reads these rows, not the tables.
    judged = quality.evaluate(written(values, "suite"), quality.expectations(spark, SUITE))
    return shown(judged).drop("error")


__all__ = ["EXPECT_SQL"]
