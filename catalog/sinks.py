"""Sinks and publication (SNK)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import AS_OF, now, source_table, table
from docmill.functions.variants import last_key_wins, payload_hash
from docmill.model import RAW
from docmill.operators import upsert
from docmill.plans import ingestion, publish
from docmill.session import work_dir, written
from docmill.sources import landed

RUN = 2
# Reference form of the hash: keys in order, no spaces.
HASH = "sha256(payload)"
_STATUS = f"""
  s AS (SELECT source, external_id, {HASH} AS h FROM v_stored),
  b AS (SELECT source, external_id, seq, {HASH} AS h, lag({HASH}) OVER (
          PARTITION BY source, external_id ORDER BY seq) AS before FROM v_batch),
  st AS (SELECT b.source, b.external_id, b.seq, CASE WHEN coalesce(before, s.h) IS NULL THEN 'new'
           WHEN coalesce(before, s.h) <> b.h THEN 'changed' ELSE 'unchanged' END AS status
         FROM b LEFT JOIN s ON s.source = b.source AND s.external_id = b.external_id)
"""


def stored(spark, sf):
    """The stored layer, as a table with its hashes."""
    return written(table(spark, sf, "v_stored").withColumn("payload_hash", payload_hash(F.col("payload"))), "stored")


def batch(spark, sf):
    return table(spark, sf, "v_batch").withColumn("payload_hash", payload_hash(F.col("payload")))


@query("snk_payload_hash", f"""
SELECT source, external_id, seq, {HASH} AS payload_hash FROM v_batch
""")
def snk_payload_hash(spark, sf):
    """The payload with its fields the other way round hashes like the canonical form."""
    rows = table(spark, sf, "v_batch")
    turned = F.regexp_replace("payload", r'^\{("cents":\d+),(.*)\}$', "{ $2 , $1 }")
    return rows.select("source", "external_id", "seq", payload_hash(turned).alias("payload_hash"))


@query("snk_payload_last_wins", f"""
SELECT source, external_id, seq, {HASH} AS payload_hash FROM v_batch
""")
def snk_payload_last_wins(spark, sf):
    """A payload that names a field twice means its last value: it hashes like the payload with that value alone."""
    last_key_wins(spark)
    doubled = F.regexp_replace("payload", r"^\{", '{"priority":"none","cents":{"a":1,"a":2},')
    return table(spark, sf, "v_batch").select("source", "external_id", "seq", payload_hash(doubled).alias("payload_hash"))


@query("snk_upsert_bronze", f"""
WITH b AS (SELECT *, {HASH} AS h FROM v_batch),
  l AS (SELECT source, external_id, arg_max(payload, seq) AS payload, arg_max(h, seq) AS h, min(h) AS lo, max(h) AS hi
        FROM b GROUP BY source, external_id),
  s AS (SELECT *, {HASH} AS h FROM v_stored),
  j AS (SELECT coalesce(s.source, l.source) AS source, coalesce(s.external_id, l.external_id) AS external_id,
          s.payload AS sp, s.h AS sh, l.payload AS lp, l.h AS lh, s.first_seen_run AS f, s.last_seen_run AS ls,
          s.updated_at AS u, l.h IS NOT NULL AND (s.h IS NULL OR lo <> s.h OR hi <> s.h) AS differs
        FROM s FULL OUTER JOIN l ON s.source = l.source AND s.external_id = l.external_id)
SELECT source, external_id, CASE WHEN differs THEN lp ELSE sp END AS payload,
  CASE WHEN differs THEN lh ELSE sh END AS payload_hash, coalesce(f, {RUN}) AS first_seen_run,
  CASE WHEN lh IS NOT NULL THEN {RUN} ELSE ls END AS last_seen_run,
  CASE WHEN differs THEN TIMESTAMP '{AS_OF}' ELSE u END AS updated_at
FROM j
""")
def snk_upsert_bronze(spark, sf):
    return upsert.upsert(stored(spark, sf), batch(spark, sf), RUN, now())


@query("snk_upsert_status_seq", f"WITH {_STATUS} SELECT * FROM st")
def snk_upsert_status_seq(spark, sf):
    return upsert.sequential_status(stored(spark, sf), batch(spark, sf)).select(
        "source", "external_id", "seq", "status")


@query("snk_upsert_counts", f"""
WITH {_STATUS} SELECT source, count(*) AS fetched, count(CASE WHEN status = 'new' THEN 1 END) AS new,
  count(CASE WHEN status = 'changed' THEN 1 END) AS changed,
  count(CASE WHEN status = 'unchanged' THEN 1 END) AS unchanged, CAST(0 AS BIGINT) AS quarantined,
  count(CASE WHEN status IS NULL THEN 1 END) AS missing_id FROM st GROUP BY source
""")
def snk_upsert_counts(spark, sf):
    return upsert.ingest_counts(upsert.sequential_status(stored(spark, sf), batch(spark, sf)), ["source"])


# Every third key's second row, or its only one, is cut short; some have a good row before it.
_BROKEN = f"""
  bad AS (SELECT *, CAST(external_id AS BIGINT) % 3 = 0 AND seq = max(seq) OVER (PARTITION BY source, external_id) AS broken FROM v_batch),
  good AS (SELECT source, external_id, seq, payload, {HASH} AS h FROM bad WHERE NOT broken),
  known AS (SELECT source, external_id, payload, {HASH} AS h FROM v_stored)"""


def broken_batch(spark, sf):
    rows = table(spark, sf, "v_batch")
    last = rows.groupBy("source", "external_id").agg(F.max("seq").alias("last"))
    cut = (F.col("external_id").cast("bigint") % 3 == 0) & (F.col("seq") == F.col("last"))
    rows = rows.join(last, ["source", "external_id"]).withColumn(
        "payload", F.when(cut, F.substring("payload", 1, 9)).otherwise(F.col("payload"))).drop("last")
    return rows.withColumn("payload_hash", payload_hash(F.col("payload")))


@query("snk_upsert_malformed", f"""
WITH {_BROKEN}, l AS (SELECT source, external_id, arg_max(payload, seq) AS payload FROM good GROUP BY source, external_id)
SELECT source, external_id, coalesce(l.payload, known.payload) AS payload, CASE WHEN l.payload IS NOT NULL THEN {RUN} ELSE 1 END AS last_seen_run
FROM known FULL OUTER JOIN l USING (source, external_id)
""")
def snk_upsert_malformed(spark, sf):
    """Unreadable payloads store nothing and never replace a readable one."""
    rows = upsert.upsert(stored(spark, sf), broken_batch(spark, sf), RUN, now())
    return rows.select("source", "external_id", "payload", F.col("last_seen_run").cast("int").alias("last_seen_run"))


@query("snk_upsert_quarantined", f"""
WITH {_BROKEN}, seen AS (SELECT g.source, g.external_id, coalesce(lag(g.h) OVER (PARTITION BY g.source, g.external_id ORDER BY seq), k.h) AS before, g.h
    FROM good g LEFT JOIN known k ON k.source = g.source AND k.external_id = g.external_id)
SELECT source, count(*) AS fetched, count(*) FILTER (status = 'new') AS new, count(*) FILTER (status = 'changed') AS changed,
  count(*) FILTER (status = 'unchanged') AS unchanged, count(*) FILTER (status = 'bad') AS quarantined
FROM (SELECT source, CASE WHEN before IS NULL THEN 'new' WHEN before <> h THEN 'changed' ELSE 'unchanged' END AS status FROM seen
  UNION ALL SELECT source, 'bad' FROM bad WHERE broken) x GROUP BY source
""")
def snk_upsert_quarantined(spark, sf):
    statuses = upsert.sequential_status(stored(spark, sf), broken_batch(spark, sf))
    return upsert.ingest_counts(statuses, ["source"]).drop("missing_id")


@query("snk_silver_rebuild", """
SELECT source, count(*) AS n, count(decision_number) AS n_numbers, 'decisions_20240131_000000' AS version
FROM v_decisions GROUP BY source
""")
def snk_silver_rebuild(spark, sf):
    """New version written aside, published, then resolved and read."""
    root, version = work_dir(spark, "rebuild"), "decisions_20240131_000000"
    rows = table(spark, sf, "v_decisions").select("source", "external_id", "decision_number", "text")
    path = publish.write_version(rows, root, version)
    publish.publish(spark, f"{root}/versions", "decisions", version, path, now())
    current = publish.current_path(spark, f"{root}/versions", "decisions")
    return spark.read.schema(rows.schema).parquet(current).groupBy("source").agg(
        F.count("*").alias("n"), F.count("decision_number").alias("n_numbers"), F.lit(version).alias("version"))


# Pages of orders: every 50th record comes without identifier, every 7th changes, every 20th cannot be read.
_RUN_SQL = f"""
  r AS (SELECT o_orderstatus AS source, o_orderkey AS k, CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS external_id FROM orders),
  old AS (SELECT source, external_id FROM v_stored),
  seen AS (SELECT r.source, r.k, r.external_id, old.external_id IS NOT NULL AS known, r.k % 20 = 3 AS broken FROM r
    LEFT JOIN old ON old.source = r.source AND old.external_id = r.external_id)"""


def ingested(spark, sf):
    """The job over pages made of orders; what is stored already is what an earlier run got."""
    orders = source_table(spark, sf, "orders")
    body = lambda changed: F.concat(
        F.lit('{"id":"'), F.col("o_orderkey"), F.lit('","n":'), F.when(changed, F.lit("2")).otherwise(F.lit("1")), F.lit("}"))
    key, never = F.col("o_orderkey"), F.lit(False)
    known = orders.join(table(spark, sf, "v_stored").select(F.col("source").alias("o_orderstatus"), F.col("external_id").cast("bigint").alias("o_orderkey")), ["o_orderstatus", "o_orderkey"], "left_semi")
    before = known.select(F.col("o_orderstatus").alias("source"), key.cast("string").alias("external_id"), body(never).alias("payload")).withColumn("payload_hash", payload_hash(F.col("payload")))
    before = before.withColumns({"first_seen_run": F.lit(1).cast("bigint"), "last_seen_run": F.lit(1).cast("bigint"), "updated_at": now()})
    fields = [F.when(key % 50 != 0, key.cast("string")).alias("id"), F.when(key % 7 == 0, 2).otherwise(1).alias("n")]
    path = work_dir(spark, "pages")
    orders.groupBy(F.col("o_orderstatus").alias("scan"), F.floor(key / 1000).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("results"), F.lit("more").alias("next_batch")).write.json(path)
    batch = ingestion.batch_of_pages(spark.read.schema(landed.PAGE_SCHEMA).json(path), "id")
    cut = (F.col("external_id").cast("bigint") % 20 == 3)
    batch = batch.withColumn("payload_hash", F.when(cut, F.lit(None)).otherwise(F.col("payload_hash")))
    root = work_dir(spark, "layer")
    counters, rows = ingestion.ingest(batch, before, RUN, now(), now(), root, "raw", "raw_20240131_000000")
    return counters, rows, publish.current_path(spark, f"{root}/versions", "raw")


@query("snk_ingest_run", f"""
WITH {_RUN_SQL}
SELECT source, count(*) AS fetched, count(*) FILTER (external_id IS NOT NULL AND NOT broken AND NOT known) AS new,
  count(*) FILTER (known AND NOT broken AND k % 7 = 0) AS changed, count(*) FILTER (known AND NOT broken AND k % 7 <> 0) AS unchanged,
  count(*) FILTER (external_id IS NOT NULL AND broken) AS quarantined, count(*) FILTER (external_id IS NULL) AS missing_id
FROM seen GROUP BY source
""")
def snk_ingest_run(spark, sf):
    """Counters of one whole ingestion run."""
    return ingested(spark, sf)[0]


@query("snk_ingest_version", f"""
WITH {_RUN_SQL}
SELECT coalesce(seen.source, old.source) AS source, count(*) AS n, count(*) FILTER (external_id IS NOT NULL AND NOT broken) AS n_seen
FROM (SELECT * FROM seen WHERE external_id IS NOT NULL AND (known OR NOT broken)) seen FULL OUTER JOIN old USING (source, external_id) GROUP BY ALL
""")
def snk_ingest_version(spark, sf):
    """The published version after the run."""
    _, rows, path = ingested(spark, sf)
    return spark.read.schema(RAW).parquet(path).groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(F.col("last_seen_run") == RUN).alias("n_seen"))


# Publication: documents without text are what the index lost, missing dates what it rejected.
_GATE = """
  e AS (SELECT source, count(*) AS n FROM v_decisions GROUP BY source),
  i AS (SELECT source, count(*) AS n FROM v_decisions WHERE trim(text, ' ') <> '' GROUP BY source),
  r AS (SELECT source, count(*) AS n FROM v_decisions WHERE decision_date IS NULL GROUP BY source),
  g AS (SELECT e.source, e.n AS expected, coalesce(i.n, 0) AS indexed, coalesce(r.n, 0) AS rejected,
          e.n = coalesce(i.n, 0) AND coalesce(r.n, 0) = 0 AS accepted
        FROM e LEFT JOIN i ON e.source = i.source LEFT JOIN r ON e.source = r.source)
"""


def gate_rows(spark, sf):
    docs = table(spark, sf, "v_decisions")
    count = lambda df: df.groupBy("source").agg(F.count("*").alias("n"))
    return publish.gate_rows(
        count(docs), count(docs.filter(F.trim("text") != "")), count(docs.filter(F.col("decision_date").isNull())))


@query("snk_publish_gate", f"WITH {_GATE} SELECT source, expected, indexed, rejected, accepted FROM g")
def snk_publish_gate(spark, sf):
    return gate_rows(spark, sf)


@query("snk_publish_verdict", f"""
WITH {_GATE}
SELECT sum(expected) > 0 AND count(CASE WHEN NOT accepted THEN 1 END) = 0 AS publish,
  CAST(sum(expected) AS BIGINT) AS n_expected, count(CASE WHEN NOT accepted THEN 1 END) AS n_mismatched,
  CASE WHEN sum(expected) = 0 THEN 'nothing to publish' WHEN bool_or(NOT accepted) THEN 'counts differ: ' || string_agg(
    printf('%s (expected %d, indexed %d, rejected %d)', source, expected, indexed, rejected), '; ' ORDER BY source) FILTER (NOT accepted) END AS reason
FROM g
""")
def snk_publish_verdict(spark, sf):
    return publish.gate(gate_rows(spark, sf))


@query("snk_retention_after", r"""
WITH v AS (SELECT DISTINCT o_orderstatus AS dataset, 'decisions_' || replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') || '_020000' AS version,
    day(o_orderdate) <> 3 AS published FROM orders WHERE day(o_orderdate) <= 3 AND month(o_orderdate) = 1),
  k AS (SELECT dataset, version, row_number() OVER (PARTITION BY dataset ORDER BY version DESC) AS rn FROM v WHERE published)
SELECT v.dataset, v.version, CASE WHEN rn <= 2 THEN 'keep' ELSE 'drop' END AS action FROM v LEFT JOIN k USING (dataset, version)
""")
def snk_retention_after(spark, sf):
    """Builds of every third of January were refused: the newest name is not the live version."""
    day = F.col("o_orderdate").cast("date")
    found = source_table(spark, sf, "orders").filter((F.day(day) <= 3) & (F.month(day) == 1)).select(
        F.col("o_orderstatus").alias("dataset"), F.concat(F.lit("decisions_"), F.date_format(day, "yyyyMMdd"), F.lit("_020000")).alias("version"), day.alias("day")).distinct()
    published = found.filter(F.day("day") != 3).select("dataset", "version", F.col("day").cast("timestamp").alias("published_at"))
    return publish.retention_after(found.drop("day"), published)


@query("snk_retention_plan", r"""
WITH v AS (SELECT DISTINCT o_orderstatus AS dataset,
    CASE WHEN o_orderpriority = '5-LOW' AND month(o_orderdate) = 1 AND day(o_orderdate) = 1 THEN 'manual_copy' ELSE
    'decisions_' || replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '') || '_020000' END AS version FROM orders),
  k AS (SELECT dataset, version, row_number() OVER (PARTITION BY dataset ORDER BY version DESC) AS rn
        FROM v WHERE regexp_matches(version, '^[a-z]+_\d{8}_\d{6}$'))
SELECT v.dataset, v.version, CASE WHEN k.rn IS NULL THEN 'ignored' WHEN rn <= 2 THEN 'keep' ELSE 'drop' END AS action
FROM v LEFT JOIN k ON v.dataset = k.dataset AND v.version = k.version
""")
def snk_retention_plan(spark, sf):
    day = F.col("o_orderdate").cast("date")
    manual = (F.col("o_orderpriority") == "5-LOW") & (F.month(day) == 1) & (F.day(day) == 1)
    versions = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("dataset"),
        F.when(manual, "manual_copy").otherwise(
            F.concat(F.lit("decisions_"), F.date_format(day, "yyyyMMdd"), F.lit("_020000"))).alias("version"),
    ).distinct()
    return publish.retention_plan(versions)


@query("snk_strict_rejects", """
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN p_size <= 10 THEN 'unknown field extra' WHEN p_size <= 15 THEN 'invalid date decided'
    WHEN p_size = 16 THEN 'not an object' END AS reason FROM part) x
WHERE reason IS NOT NULL GROUP BY reason
""")
def snk_strict_rejects(spark, sf):
    size = F.col("p_size")
    doc = (
        F.when(size <= 10, F.concat(F.lit('{"name":"'), "p_name", F.lit('","extra":1}')))
        .when(size <= 15, F.concat(F.lit('{"name":"'), "p_name", F.lit('","decided":"2026-02-30"}')))
        .when(size == 16, F.lit("[1]"))
        .otherwise(F.concat(F.lit('{"name":"'), "p_name", F.lit('","decided":"2026-02-28"}')))
    )
    docs = table(spark, sf, "part").select(F.col("p_brand").alias("source"), doc.alias("doc"))
    return publish.strict_rejects(docs, ["name", "decided"], ["decided"]).groupBy("reason").agg(F.count("*").alias("n"))


@query("snk_count_coverage", """
SELECT count(*) AS total, count(issuer) AS covered, count(*) = count(issuer) AS complete FROM v_decisions
""")
def snk_count_coverage(spark, sf):
    """The issuer is unknown for one language, so the groups do not cover everything."""
    return publish.count_coverage(table(spark, sf, "v_decisions").select(F.col("issuer").alias("source")))


@query("snk_index_stats", f"""
WITH {_GATE} SELECT {RUN} AS run_id, 'decisions_20240131_000000' AS index_name, source, expected AS silver_count,
  indexed AS indexed_count, rejected AS rejected_count, FALSE AS alias_switched, TIMESTAMP '{AS_OF}' AS created_at FROM g
""")
def snk_index_stats(spark, sf):
    """History rows of a refused publication, appended and read back."""
    rows = publish.index_stats_rows(RUN, "decisions_20240131_000000", gate_rows(spark, sf), F.lit(False), now())
    path = work_dir(spark, "index-stats")
    rows.write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
