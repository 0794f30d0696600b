"""Structured Streaming (ST): each stream runs until its available input is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.sinks import batch, stored
from catalog.sources import landed_pages_path
from catalog.views import source_table
from docmill.session import work_dir
from docmill.sources import landed
from docmill.streaming import ingest

BATCH = "source STRING, external_id STRING, seq BIGINT, payload STRING, payload_hash STRING"


@query("st_ingest", """
SELECT o_orderstatus AS scan, o_orderkey AS id, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
""")
def st_ingest(spark, sf):
    """Landed page files become records as they arrive."""
    pages = ingest.read_pages(spark, landed_pages_path(spark, sf), landed.PAGE_SCHEMA)
    records = pages.select("scan", F.explode("results").alias("v")).select(
        "scan", F.try_variant_get("v", "$.id", "bigint").alias("id"),
        F.try_variant_get("v", "$.cents", "bigint").alias("cents"))
    out = work_dir(spark, "records")
    ingest.append_to(records, out, work_dir(spark, "records-state"))
    return spark.read.schema(records.schema).parquet(out)


@query("st_dedup_overlap", "SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, sha256(props) AS hash FROM events")
def st_dedup_overlap(spark, sf):
    """All events, then those of the last 14 days read again, one file a micro-batch: every version
    comes out once, however late it is."""
    rows = source_table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.sha2("props", 256).alias("hash"))
    path = work_dir(spark, "reads")
    latest = rows.agg(F.max("ts")).scalar()
    rows.repartition(3, "hash").write.mode("append").parquet(path)
    rows.filter(F.col("ts") > latest - F.expr("INTERVAL 14 DAYS")).write.mode("append").parquet(path)
    stream = ingest.read_table_stream(spark, path, "event_id BIGINT, ts TIMESTAMP, hash STRING", files_per_trigger=1)
    out = work_dir(spark, "once")
    ingest.append_once(stream, ["event_id", "ts", "hash"], "ts", out, work_dir(spark, "once-state"))
    return spark.read.schema(rows.schema).parquet(out).select(*rows.columns)


UPSERT_SQL = """
WITH l AS (SELECT source, external_id, arg_max(payload, seq) AS payload FROM v_batch GROUP BY source, external_id)
SELECT source, external_id, coalesce(l.payload, s.payload) AS payload, sha256(coalesce(l.payload, s.payload)) AS payload_hash
FROM l FULL OUTER JOIN v_stored s USING (source, external_id)
"""


def upserted(spark, sf, start):
    """The stored layer lands first, the batch after it; the log folds to what batch upsert gives."""
    path = work_dir(spark, "landing")
    first = stored(spark, sf).select("source", "external_id", F.lit(0).cast("bigint").alias("seq"), "payload", "payload_hash")
    first.write.mode("append").parquet(path)
    batch(spark, sf).select("source", "external_id", "seq", "payload", "payload_hash").write.mode("append").parquet(path)
    log = work_dir(spark, "log")
    start(ingest.read_table_stream(spark, path, BATCH), log, work_dir(spark, "log-state")).awaitTermination()
    return ingest.current_state(spark, log).select("source", "external_id", "payload", "payload_hash")


@query("st_upsert", UPSERT_SQL)
def st_upsert(spark, sf):
    return upserted(spark, sf, ingest.start_upsert)


@query("st_upsert_keyed", UPSERT_SQL)
def st_upsert_keyed(spark, sf):
    """The same with the last hashes in the state store."""
    return upserted(spark, sf, ingest.start_keyed_upsert)
