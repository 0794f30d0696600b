"""Dashboard queries (DB)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.relational import END, RANGE, RESULTS_SQL, START, STEPS, _WIDE, check_results, shown, series_sql
from catalog.views import AS_OF, now, table
from docmill.plans import reports
from docmill.session import written

DURATION = "CAST(epoch_us(finished_at) - epoch_us(started_at) AS DOUBLE) / 1000000"


def runs(spark, sf):
    return table(spark, sf, "v_runs")


@query("db_last_status", "SELECT status FROM v_runs WHERE source = 'click' AND status <> 'skipped' ORDER BY run_id DESC LIMIT 1")
def db_last_status(spark, sf):
    return reports.last_status(runs(spark, sf), "click")


@query("db_last_run_detail", f"""
SELECT run_id, date_type, started_at, {DURATION} AS duration, status, error FROM v_runs
WHERE source = 'click' AND status <> 'skipped' ORDER BY run_id DESC LIMIT 1
""")
def db_last_run_detail(spark, sf):
    return reports.last_run_detail(runs(spark, sf), "click")


@query("db_run_durations", f"""
SELECT started_at AS time, status AS metric, {DURATION} AS value FROM v_runs
WHERE source = 'click' AND status IN ('success', 'failed') AND started_at {RANGE}
""")
def db_run_durations(spark, sf):
    return reports.run_durations(runs(spark, sf), "click", START, END)


@query("db_hours_wide", f"SELECT {_WIDE} FROM v_runs WHERE status = 'success'")
def db_hours_wide(spark, sf):
    return reports.hours_wide(runs(spark, sf), now(), STEPS)


@query("db_run_history", f"""
SELECT run_id, started_at, date_type, status, {DURATION} AS duration, error FROM v_runs WHERE source = 'click' AND started_at {RANGE}
""")
def db_run_history(spark, sf):
    return reports.run_history(runs(spark, sf), "click", START, END)


@query("db_volumes_by_run", f"""
SELECT started_at AS time, nb_fetched, nb_new, nb_changed FROM v_runs
WHERE source = 'view' AND status <> 'running' AND started_at {RANGE}
""")
def db_volumes_by_run(spark, sf):
    return reports.volumes_by_run(runs(spark, sf), "view", START, END)


@query("db_new_changed", f"""
SELECT started_at AS time, source AS metric, nb_new + nb_changed AS value FROM v_runs
WHERE source IN ('view', 'click', 'error') AND status <> 'running' AND started_at {RANGE}
""")
def db_new_changed(spark, sf):
    return reports.new_changed(runs(spark, sf), ["view", "click", "error"], START, END)


@query("db_collection_runs", f"""
SELECT run_id, source, started_at, date_type, strftime(date_start, '%d/%m/%Y') AS date_from, strftime(date_end, '%d/%m/%Y') AS date_to,
  status, {DURATION} AS duration, nb_fetched, nb_new, nb_changed, error FROM v_runs
WHERE source IN ('view', 'click') AND started_at {RANGE}
""")
def db_collection_runs(spark, sf):
    return reports.collection_runs(runs(spark, sf), ["view", "click"], START, END)


@query("db_state_timeline", f"""
WITH {RESULTS_SQL} SELECT checked_at AS time, check_name || ' / ' || coalesce(source, '—') AS metric,
  CASE status WHEN 'pass' THEN 0 WHEN 'unchecked' THEN 1 WHEN 'no_data' THEN 2 WHEN 'fail' THEN 3 WHEN 'query_error' THEN 4 END AS value
FROM results WHERE check_name IN ('low_value', 'zero_key') AND checked_at {RANGE}
""")
def db_state_timeline(spark, sf):
    return reports.state_timeline(check_results(spark, sf), ["low_value", "zero_key"], START, END)


@query("db_last_deviations", f"""
WITH {RESULTS_SQL} SELECT check_name, source, dimension, severity, status, value, expected, error FROM results
WHERE run_id = (SELECT max(run_id) FROM results) AND status <> 'pass'
""")
def db_last_deviations(spark, sf):
    return shown(reports.last_deviations(written(check_results(spark, sf), "history")))


def _series(name: str, check: str) -> None:
    @query(name, series_sql(check))
    def db_value_threshold(spark, sf):
        return shown(reports.value_threshold(check_results(spark, sf), check, START, END))


_series("db_value_threshold", "low_value")
_series("db_value_threshold_repeated", "repeated_user")
_series("db_value_threshold_zero", "zero_key")


@query("db_indexed_counts", f"""
SELECT created_at AS time, source AS metric, indexed_count AS value FROM v_index_stats WHERE alias_switched AND created_at {RANGE}
""")
def db_indexed_counts(spark, sf):
    return reports.indexed_counts(table(spark, sf, "v_index_stats"), START, END)


@query("db_rebuilds", f"""
SELECT run_id, created_at, index_name, source, silver_count, indexed_count, rejected_count,
  CASE WHEN alias_switched THEN 'oui' ELSE 'non' END AS switched FROM v_index_stats WHERE created_at {RANGE}
""")
def db_rebuilds(spark, sf):
    return reports.rebuilds(table(spark, sf, "v_index_stats"), START, END)


@query("db_findability_number", f"""
SELECT created_at AS time, hit_at_1, hit_at_10, mrr FROM v_evals WHERE mode = 'number' AND created_at {RANGE}
""")
def db_findability_number(spark, sf):
    return reports.findability_number(table(spark, sf, "v_evals"), START, END)


@query("db_findability_title", f"""
SELECT created_at AS time, name || ' (poids ' || rtrim(rtrim(CAST(CAST(title_boost AS DECIMAL(5,2)) AS STRING), '0'), '.') || ')' AS metric,
  value FROM v_evals, LATERAL (VALUES ('hit@1', hit_at_1), ('hit@10', hit_at_10), ('MRR', mrr)) AS m(name, value)
WHERE mode = 'title' AND created_at {RANGE}
""")
def db_findability_title(spark, sf):
    return reports.findability_title(table(spark, sf, "v_evals"), START, END)


@query("db_hit1_by_group", f"""
SELECT time, metric, avg(CASE WHEN rank = 1 THEN 1.0 ELSE 0.0 END) AS value FROM (
  SELECT r.created_at AS time, f.rank, unnest([CASE WHEN f.ambiguous_title THEN 'titre ambigu' ELSE 'titre non ambigu' END,
    CASE WHEN f.has_text THEN 'avec texte' ELSE 'sans texte' END]) AS metric
  FROM v_eval_results f JOIN v_evals r ON r.eval_id = f.eval_id
  WHERE r.mode = 'title' AND r.title_boost = 2 AND r.created_at {RANGE}) x
GROUP BY time, metric
""")
def db_hit1_by_group(spark, sf):
    return reports.hit1_by_group(table(spark, sf, "v_eval_results"), table(spark, sf, "v_evals"), START, END)


@query("db_pick_lists", f"""
WITH {RESULTS_SQL} SELECT 'source' AS list, source AS item FROM (SELECT DISTINCT source FROM v_runs WHERE source IN ('click', 'view', 'ghost')) a
UNION ALL SELECT 'dimension', dimension FROM (SELECT DISTINCT dimension FROM results) b
UNION ALL SELECT 'check', check_name FROM (SELECT DISTINCT check_name FROM results WHERE dimension IN ('validity', 'uniqueness')) c
""")
def db_pick_lists(spark, sf):
    results = written(check_results(spark, sf), "history")
    parts = [
        ("source", reports.pick_list(runs(spark, sf), "source", F.col("source").isin("click", "view", "ghost"))),
        ("dimension", reports.pick_list(results, "dimension")),
        ("check", reports.pick_list(results, "check_name", F.col("dimension").isin("validity", "uniqueness"))),
    ]
    lists = [df.select(F.lit(name).alias("list"), F.col(df.columns[0]).alias("item")) for name, df in parts]
    return lists[0].unionByName(lists[1]).unionByName(lists[2])
