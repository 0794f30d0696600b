"""How the given tables become the inputs of the operators.

Each view is portable SQL, evaluated alike by Spark (``table``) and by the checking engine (as a
common table expression). Views derive columns; they keep every row of their table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TITLED, WHOLE = "src0", "src1"
AS_OF = "2024-01-31 00:00:00"
AS_OF_DATE = "2024-01-31"

VIEWS: dict[str, str] = {}

# Documents as decisions. Shared numbers, wrong years, blank texts, missing dates and titles are
# derived from the identifier so that every check has something to find.
VIEWS["v_decisions"] = """
SELECT doc_id, lang, source, CAST(doc_id AS STRING) AS external_id,
  CASE WHEN doc_id % 41 = 0 THEN NULL
       ELSE lpad(CAST(yr % 100 AS STRING), 2, '0') || '-A-' || CAST(k AS STRING) END AS decision_number,
  CASE lang WHEN 'fr' THEN 'Cour de cassation' WHEN 'en' THEN 'Tribunal judiciaire'
            WHEN 'de' THEN 'Cour d''appel' END AS issuer,
  CASE doc_id % 5 WHEN 0 THEN 'decision' WHEN 1 THEN 'avis' WHEN 2 THEN 'concentration'
                  WHEN 3 THEN 'lettre_ministre' END AS decision_type,
  CASE WHEN doc_id % 53 = 0 THEN NULL
       ELSE make_date(CAST(yr - CASE WHEN doc_id % 60 = 7 THEN 3 ELSE 0 END AS INT), 1, 1)
            + CAST(doc_id % 365 AS INT) END AS decision_date,
  CASE WHEN doc_id % 43 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title,
  CASE WHEN doc_id % 37 = 0 THEN '  ' ELSE text END AS text,
  lang || '|' || CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'middle' ELSE 'long' END
    AS sectors_text,
  'https://decisions.example.org/' || source || '/' || CAST(doc_id AS STRING) AS url,
  CASE WHEN doc_id % 31 = 0 THEN '{"ecli":null}'
       ELSE '{"ecli":"ECLI:' || lang || ':' || CAST(k AS STRING) || '","chars":' || CAST(n_chars AS STRING) || '}'
  END AS attributes
FROM (
  SELECT *, 1990 + k % 35 AS yr
  FROM (SELECT *, CASE WHEN doc_id % 25 = 0 THEN doc_id + 1 ELSE doc_id END AS k FROM documents) d0
) d1
"""

# Orders as a stored layer (what was known before 2000) and as a batch that reads everything
# again: urgent orders changed, high-priority finished ones come twice with another content.
_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
_PAYLOAD = """'{"cents":' || CAST(cents AS STRING) || ',"priority":"' || o_orderpriority || '"}'"""
VIEWS["v_stored"] = f"""
SELECT o_orderstatus AS source, CAST(o_orderkey AS STRING) AS external_id, {_PAYLOAD} AS payload,
  CAST(1 AS BIGINT) AS first_seen_run, CAST(1 AS BIGINT) AS last_seen_run,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS updated_at
FROM (SELECT *, {_CENTS} AS cents FROM orders) o WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
"""
VIEWS["v_batch"] = f"""
SELECT o_orderstatus AS source, CAST(o_orderkey AS STRING) AS external_id, seq, {_PAYLOAD} AS payload
FROM (
  SELECT o_orderstatus, o_orderkey, o_orderpriority, CAST(1 AS BIGINT) AS seq,
    {_CENTS} + CASE WHEN o_orderpriority = '1-URGENT' THEN 100 ELSE 0 END AS cents FROM orders
  UNION ALL
  SELECT o_orderstatus, o_orderkey, o_orderpriority, CAST(2 AS BIGINT) AS seq, {_CENTS} + 200 AS cents
  FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'
) o
"""

# Events as a run log.
VIEWS["v_runs"] = f"""
SELECT run_id, source, date_type, date_start, date_end, started_at,
  CASE WHEN status = 'running' THEN NULL ELSE started_at + INTERVAL '1' SECOND * seconds END AS finished_at,
  status, nb_fetched, nb_new, nb_changed,
  CASE WHEN status = 'failed' THEN 'failure ' || props END AS error
FROM (
  SELECT event_id AS run_id, event_type AS source,
    CASE user_id % 3 WHEN 0 THEN 'creation' WHEN 1 THEN 'update' END AS date_type,
    CAST(ts AS DATE) - 7 AS date_start, CAST(ts AS DATE) AS date_end,
    CAST(ts AS TIMESTAMP) AS started_at, CAST(floor(value) AS INT) AS seconds,
    CASE WHEN event_id % 97 = 0 THEN 'running' WHEN event_id % 89 = 0 THEN 'skipped'
         WHEN user_id % 10 = 0 THEN 'failed' ELSE 'success' END AS status,
    n AS nb_fetched, n % 7 AS nb_new, n % 11 AS nb_changed, props
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS n FROM events) e0
) e1
"""

# Events as check values: one run per day, four checks per event type; a check that has nothing
# to measure on some source gives NULL there, which is a malformed result.
VIEWS["v_check_values"] = """
SELECT run_id, checked_at, check_name, source, value FROM (
  SELECT CAST(year(d) * 372 + month(d) * 31 + day(d) AS BIGINT) AS run_id,
    CAST(d AS TIMESTAMP) + INTERVAL '1' DAY AS checked_at, source,
    CAST(count(CASE WHEN value < 2 THEN 1 END) AS BIGINT) AS low_value,
    CAST(count(CASE WHEN n > 97 THEN 1 END) AS BIGINT) AS high_key,
    CAST(count(*) - count(DISTINCT user_id) AS BIGINT) AS repeated_user,
    CAST(nullif(count(CASE WHEN n = 0 THEN 1 END), 0) AS BIGINT) AS zero_key
  FROM (SELECT CAST(ts AS DATE) AS d, event_type AS source, value, user_id,
          CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS n FROM events) e0
  GROUP BY d, source
) w UNPIVOT INCLUDE NULLS (value FOR check_name IN (low_value, high_key, repeated_user, zero_key))
"""

# Events as index history: one rebuild per day; large values are rejected documents,
# and a version counts as published when fewer than one in twenty was rejected.
VIEWS["v_index_stats"] = """
SELECT run_id, 'decisions_' || replace(CAST(d AS STRING), '-', '') || '_020000' AS index_name, source,
  silver_count, silver_count - rejected_count AS indexed_count, rejected_count,
  day_rejected * 20 < day_count AS alias_switched, CAST(d AS TIMESTAMP) + INTERVAL '2' HOUR AS created_at
FROM (
  SELECT s.*, t.day_rejected, t.day_count FROM (
    SELECT CAST(year(d) * 372 + month(d) * 31 + day(d) AS BIGINT) AS run_id, d, source,
      CAST(count(*) AS BIGINT) AS silver_count, CAST(count(CASE WHEN value > 150 THEN 1 END) AS BIGINT) AS rejected_count
    FROM (SELECT CAST(ts AS DATE) AS d, event_type AS source, value FROM events) e0 GROUP BY d, source
  ) s JOIN (
    SELECT CAST(ts AS DATE) AS d, CAST(count(CASE WHEN value > 150 THEN 1 END) AS BIGINT) AS day_rejected,
      CAST(count(*) AS BIGINT) AS day_count FROM events GROUP BY CAST(ts AS DATE)
  ) t ON s.d = t.d
) j
"""

# Events as evaluation results: one evaluation per day and event type; keys 1 to 10 are ranks.
VIEWS["v_eval_results"] = """
SELECT event_id AS result_id, day_no * 10 + kind AS eval_id, day_no AS run_id,
  CASE kind WHEN 0 THEN 'number' ELSE 'title' END AS mode,
  CASE kind WHEN 0 THEN NULL ELSE CAST(kind AS DOUBLE) END AS title_boost,
  'doc' || CAST(user_id AS STRING) AS doc_id,
  value > 3 AS has_text, user_id % 7 = 0 AS ambiguous_title, user_id % 11 = 0 AS ambiguous_number,
  CASE WHEN n % 16 BETWEEN 1 AND 10 THEN n % 16 END AS rank, n AS total_hits,
  CAST(d AS TIMESTAMP) + INTERVAL '3' HOUR AS created_at
FROM (
  SELECT *, CAST(year(d) * 372 + month(d) * 31 + day(d) AS BIGINT) AS day_no,
    CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END
      AS kind
  FROM (SELECT *, CAST(ts AS DATE) AS d, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS n FROM events) e0
) e1
"""
VIEWS["v_evals"] = """
SELECT eval_id, run_id, mode, title_boost, created_at, CAST(count(*) AS BIGINT) AS sample_size,
  round(avg(CAST(CASE WHEN rank = 1 THEN 1 ELSE 0 END AS DOUBLE)), 4) AS hit_at_1,
  round(avg(CAST(CASE WHEN rank IS NOT NULL THEN 1 ELSE 0 END AS DOUBLE)), 4) AS hit_at_10,
  round(avg(CASE WHEN rank IS NOT NULL THEN CAST(1 AS DOUBLE) / rank ELSE CAST(0 AS DOUBLE) END), 4) AS mrr
FROM v_eval_results GROUP BY eval_id, run_id, mode, title_boost, created_at
"""

# Pages as a site listing, and the addresses a dataset already knows: those without a query.
VIEWS["v_listing"] = """
SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages
"""


def now() -> Column:
    """The moment every query takes as the present."""
    return F.lit(AS_OF).cast("timestamp")


def today() -> Column:
    return F.lit(AS_OF_DATE).cast("date")


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a view over given tables, as a lazy DataFrame."""
    if name in TABLES:
        return source_table(spark, sf_dir, name)
    body = VIEWS[name]
    inputs = {
        used: table(spark, sf_dir, used)
        for used in (*TABLES, *VIEWS)
        if used != name and re.search(rf"\b(?:FROM|JOIN)\s+{used}\b", body)
    }
    text = body
    for used in inputs:
        text = re.sub(rf"\b(FROM|JOIN)\s+{used}\b", rf"\1 {{{used}}}", text)
    text = text.replace("'{\"", "'{{\"").replace("\"}'", "\"}}'").replace("|| '}'", "|| '}}'")
    text = text.replace(":null}'", ":null}}'")
    df = spark.sql(text, **inputs)
    if name == "v_decisions":
        df = df.withColumn("sectors", F.split("sectors_text", r"\|"))
    return df
