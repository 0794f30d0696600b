"""Known-item evaluation (FD)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.relational import METRICS_SQL, SAMPLE_SQL, _NUMBER_KEY, _TITLE_KEY
from catalog.scalars import fold_sql, strip_sql
from catalog.text_search import published_index, scores_sql
from catalog.views import TITLED, WHOLE, now, table
from docmill.plans import findability
from docmill.session import work_dir, written

BOOSTS = [1.0, 2.0]
_TARGETS = f"""{SAMPLE_SQL},
  flags AS (SELECT source, external_id, decision_number, title, NOT (text IS NULL OR trim(text, ' ') = '') AS has_text,
      {_TITLE_KEY} IS NOT NULL AND count(*) OVER (PARTITION BY {_TITLE_KEY}) > 1 AS ambiguous_title,
      {_NUMBER_KEY} IS NOT NULL AND count(*) OVER (PARTITION BY {_NUMBER_KEY}) > 1 AS ambiguous_number
    FROM v_decisions),
  targets AS (SELECT source || '|' || external_id AS doc_id, flags.* FROM flags JOIN picked USING (source, external_id))"""
_RANKS = f"""{_TARGETS},
  tt AS (SELECT *, sha256(title) AS query_id FROM targets WHERE source = '{TITLED}' AND nullif({strip_sql('title')}, '') IS NOT NULL),
  ask AS (SELECT DISTINCT query_id, title AS query FROM tt), {scores_sql()},
  best AS (SELECT query_id, b AS title_boost, doc_key, round(max(CASE field WHEN 'title' THEN b ELSE 1.0 END * score), 6) AS score
    FROM sc, (VALUES (CAST(1 AS DOUBLE)), (2)) x(b) GROUP BY query_id, b, doc_key),
  top AS (SELECT *, row_number() OVER (PARTITION BY query_id, title_boost ORDER BY score DESC, doc_key) AS rank,
      count(*) OVER (PARTITION BY query_id, title_boost) AS total_hits FROM best),
  numbers AS (SELECT doc_key, row_number() OVER (PARTITION BY k ORDER BY doc_key) AS rank, count(*) OVER (PARTITION BY k) AS total_hits
    FROM (SELECT source || '|' || external_id AS doc_key, {fold_sql('decision_number')} AS k FROM v_decisions) x WHERE k IS NOT NULL),
  ranks AS (
    SELECT 'number' AS mode, CAST(NULL AS DOUBLE) AS title_boost, doc_id, decision_number, title, has_text, ambiguous_title,
      ambiguous_number, CASE WHEN rank <= 10 THEN rank END AS rank, coalesce(total_hits, 0) AS total_hits
    FROM targets LEFT JOIN numbers ON doc_key = doc_id WHERE {_NUMBER_KEY} IS NOT NULL
    UNION ALL
    SELECT 'title', b, doc_id, decision_number, title, has_text, ambiguous_title, ambiguous_number,
      CASE WHEN top.rank <= 10 THEN top.rank END, coalesce(n.total_hits, 0)
    FROM tt CROSS JOIN (VALUES (CAST(1 AS DOUBLE)), (2)) x(b)
      LEFT JOIN top ON top.query_id = tt.query_id AND top.title_boost = b AND top.doc_key = tt.doc_id
      LEFT JOIN (SELECT query_id, title_boost, max(total_hits) AS total_hits FROM top GROUP BY query_id, title_boost) n
        ON n.query_id = tt.query_id AND n.title_boost = b)"""


def evaluated(spark, sf):
    docs = table(spark, sf, "v_decisions")
    rows = findability.targets(docs, findability.sample(docs, TITLED, WHOLE))
    return written(findability.evaluate(docs, rows, TITLED, BOOSTS, published_index(spark, sf, postings=False), stem=False), "evaluation")


@query("fd_sample", f"WITH {_TARGETS} SELECT source, external_id, decision_number, md5(title) AS title, has_text FROM targets")
def fd_sample(spark, sf):
    return findability.sample(table(spark, sf, "v_decisions"), TITLED, WHOLE).withColumn("title", F.md5("title"))


@query("fd_targets", f"WITH {_TARGETS} SELECT doc_id, decision_number, has_text, ambiguous_title, ambiguous_number FROM targets")
def fd_targets(spark, sf):
    docs = table(spark, sf, "v_decisions")
    return findability.targets(docs, findability.sample(docs, TITLED, WHOLE)).select(
        "doc_id", "decision_number", "has_text", "ambiguous_title", "ambiguous_number")


@query("fd_ranks", f"WITH {_RANKS} SELECT mode, title_boost, doc_id, rank, total_hits FROM ranks")
def fd_ranks(spark, sf):
    return evaluated(spark, sf).select("mode", "title_boost", "doc_id", "rank", "total_hits")


_ROUNDED = ("mode, title_boost, sample_size, round(hit_at_1, 4) AS hit_at_1, round(hit_at_10, 4) AS hit_at_10, "
            "round(mrr, 4) AS mrr")


@query("fd_metrics", f"WITH {_RANKS}, m AS (SELECT mode, title_boost, {METRICS_SQL} FROM ranks GROUP BY mode, title_boost) SELECT {_ROUNDED} FROM m")
def fd_metrics(spark, sf):
    return findability.metrics(evaluated(spark, sf)).select(
        "mode", "title_boost", "sample_size", *[F.round(c, 4).alias(c) for c in ("hit_at_1", "hit_at_10", "mrr")])


@query("fd_group_metrics", f"""
WITH {_RANKS},
  g AS (SELECT mode, title_boost, rank, unnest(['has_text', 'ambiguous_title', 'ambiguous_number']) AS "group",
    unnest([has_text, ambiguous_title, ambiguous_number]) AS value FROM ranks),
  grid AS (SELECT mode, title_boost, f AS "group", b AS value FROM (SELECT DISTINCT mode, title_boost FROM ranks),
    (VALUES ('has_text'), ('ambiguous_title'), ('ambiguous_number')) x(f), (VALUES (TRUE), (FALSE)) y(b)),
  m AS (SELECT mode, title_boost, "group", value, {METRICS_SQL} FROM g GROUP BY mode, title_boost, "group", value)
SELECT grid.mode, grid.title_boost, grid."group", grid.value, coalesce(sample_size, 0) AS sample_size,
  round(hit_at_1, 4) AS hit_at_1, round(hit_at_10, 4) AS hit_at_10, round(mrr, 4) AS mrr
FROM grid LEFT JOIN m ON grid.mode = m.mode AND grid.title_boost IS NOT DISTINCT FROM m.title_boost
  AND grid."group" = m."group" AND grid.value = m.value
""")
def fd_group_metrics(spark, sf):
    found = findability.group_metrics(evaluated(spark, sf))
    return found.withColumns({c: F.round(c, 4) for c in ("hit_at_1", "hit_at_10", "mrr")})


@query("fd_misses_pivot", f"""
WITH {_RANKS},
  p AS (SELECT doc_id, decision_number, title, max(CASE WHEN title_boost = 1 THEN rank END) AS "title_1.0",
      max(CASE WHEN title_boost = 2 THEN rank END) AS "title_2.0" FROM ranks WHERE mode = 'title'
    GROUP BY doc_id, decision_number, title)
SELECT doc_id, decision_number, title, CASE WHEN length({strip_sql('title')}) <= 80 THEN {strip_sql('title')}
  ELSE substring({strip_sql('title')}, 1, 79) || '…' END AS shown_title, "title_1.0", "title_2.0"
FROM p WHERE "title_1.0" IS NULL OR "title_2.0" IS NULL
""")
def fd_misses_pivot(spark, sf):
    rows = evaluated(spark, sf).filter(F.col("mode") == "title")
    return findability.misses(rows, [("title", b) for b in BOOSTS])


# The last word of a title alone: many documents share it, so many targets are missed.
_HARD_RANKS = _RANKS.replace("sha256(title) AS query_id", "sha256(regexp_extract(title, '[^ ]*$')) AS query_id").replace(
    "SELECT DISTINCT query_id, title AS query FROM tt", "SELECT DISTINCT query_id, regexp_extract(title, '[^ ]*$') AS query FROM tt")


@query("fd_misses_hard", f"""
WITH {_HARD_RANKS},
  p AS (SELECT doc_id, decision_number, title, max(CASE WHEN mode = 'number' THEN rank END) AS number,
      max(CASE WHEN title_boost = 1 THEN rank END) AS "title_1.0", max(CASE WHEN title_boost = 2 THEN rank END) AS "title_2.0"
    FROM ranks GROUP BY doc_id, decision_number, title)
SELECT doc_id, decision_number, title, number, "title_1.0", "title_2.0"
FROM p WHERE number IS NULL OR "title_1.0" IS NULL OR "title_2.0" IS NULL
""")
def fd_misses_hard(spark, sf):
    """Misses of searches by number and by the last word of the title."""
    docs = table(spark, sf, "v_decisions")
    rows = findability.targets(docs, findability.sample(docs, TITLED, WHOLE))
    last = F.regexp_extract("title", "[^ ]*$", 0)
    found = written(findability.evaluate(docs, rows, TITLED, BOOSTS, published_index(spark, sf, postings=False), stem=False, asked=last), "evaluation")
    return findability.misses(found, [("number", None), *(("title", b) for b in BOOSTS)]).drop("shown_title")


@query("fd_history", f"""
WITH {_RANKS}, m AS (SELECT mode, title_boost, {METRICS_SQL} FROM ranks GROUP BY mode, title_boost)
SELECT 6 + row_number() OVER (ORDER BY mode, title_boost NULLS FIRST) AS eval_id, mode, CAST(title_boost AS DOUBLE) AS title_boost, sample_size,
  round(hit_at_1, 4) AS hit_at_1, round(hit_at_10, 4) AS hit_at_10, round(mrr, 4) AS mrr, sample_size AS n_rows FROM m
""")
def fd_history(spark, sf):
    """One evaluation run appended to the history, and read back with the rows behind each evaluation."""
    root = work_dir(spark, "history")
    evals, rows = findability.history(evaluated(spark, sf), 3, 7, "decisions_20240131_000000", now())
    findability.append_history(evals, rows, root)
    counted = spark.read.schema(rows.schema).parquet(f"{root}/eval_results").groupBy("eval_id").agg(F.count("*").alias("n_rows"))
    figures = [F.col(c).cast("double").alias(c) for c in ("title_boost", "hit_at_1", "hit_at_10", "mrr")]
    return spark.read.schema(evals.schema).parquet(f"{root}/evals").join(counted, "eval_id").select(
        "eval_id", "mode", F.col("sample_size").cast("bigint").alias("sample_size"), *figures, "n_rows")
