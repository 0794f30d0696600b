"""Sources (SRC)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.payloads import LISTS, TYPES, authority_records, index
from catalog.registry import pick, query, sql_text
from catalog.views import source_table, table
from docmill.functions.urls import host
from docmill.functions.variants import kind
from docmill.plans import publish
from docmill.session import work_dir
from docmill.sources import bronze, json_arrays, landed, listing, policy

PAGE = 1000
VOID, TEXT, ITEMS = "NULL", "STRING", "ARRAY"


def _kinds(cases: list) -> list[str]:
    """Outer JSON type of each case fragment."""
    first = {"[": "ARRAY", '"': "STRING", "{": "OBJECT", "n": "VOID"}
    return [first.get(c[0][0], "BIGINT") for c in cases]


@query("src_json_snapshot", f"""
SELECT 'https://decisions.example.org/' || CAST(p_partkey AS STRING) AS url, p_name AS title,
  {pick(_kinds(TYPES), index('p_partkey', TYPES))} AS type_kind,
  {pick(_kinds(LISTS), index('p_partkey', LISTS))} AS sectors_kind
FROM part
""")
def src_json_snapshot(spark, sf):
    """Array files landed from part payloads, read element by element, each file by as many tasks as it has splits."""
    path = work_dir(spark, "snapshot")
    records = authority_records(spark, sf).select(
        F.floor(F.col("p_partkey") / PAGE).alias("page"), "payload")
    arrays = records.groupBy("page").agg(F.array_join(F.collect_list("payload"), ",").alias("body"))
    arrays.select("page", F.concat(F.lit("["), "body", F.lit("]")).alias("value")).write.partitionBy(
        "page").text(path)
    schema = "url_site STRING, titre_decision STRING, type_decision VARIANT, secteur_activite VARIANT"
    rows = json_arrays.read_array(spark, path, schema)
    outer = lambda c: F.regexp_extract(kind(F.col(c)), "^[A-Z]+", 0)
    return rows.select(
        bronze.stable_id(F.col("url_site")).alias("url"), F.col("titre_decision").alias("title"),
        outer("type_decision").alias("type_kind"), outer("secteur_activite").alias("sectors_kind"))


def landed_pages_path(spark, sf):
    """Cursor pages of orders, written as JSON."""
    path = work_dir(spark, "pages")
    orders = source_table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("scan"), F.floor(F.col("o_orderkey") / PAGE).alias("page"),
        F.struct(F.col("o_orderkey").alias("id"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
                 F.col("o_orderpriority").alias("priority")).alias("record"))
    last = orders.groupBy("scan").agg(F.max("page").alias("last"))
    pages = orders.groupBy("scan", "page").agg(F.array_sort(F.collect_list("record")).alias("results"))
    pages.join(last, "scan").select(
        "scan", "page",
        F.when(F.col("page") < F.col("last"), F.concat(F.lit("page="), (F.col("page") + 1).cast("string")))
        .alias("next_batch"), "results").write.json(path)
    return path


def landed_pages(spark, sf):
    """The pages read back, their results as VARIANT."""
    return spark.read.schema(landed.PAGE_SCHEMA).json(landed_pages_path(spark, sf))


@query("src_paged_batches", f"""
SELECT o_orderstatus AS scan, o_orderkey AS id, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
  CAST(floor(o_orderkey / {PAGE}) AS BIGINT) * 4294967296 + row_number() OVER (
    PARTITION BY o_orderstatus, floor(o_orderkey / {PAGE}) ORDER BY o_orderkey) - 1 AS seq
FROM orders
""")
def src_paged_batches(spark, sf):
    records = landed.page_records(landed_pages(spark, sf))
    return records.select(
        "scan", F.try_variant_get("v", "$.id", "bigint").alias("id"),
        F.try_variant_get("v", "$.cents", "bigint").alias("cents"), "seq")


CARDS = 20


def listing_pages(spark, sf):
    """Listing pages of twenty cards each, written from the given pages."""
    rows = table(spark, sf, "v_listing").select(
        "page_id", "url", F.regexp_replace("title", r"[&<>;]", " ").alias("title"))
    number = F.col("page_id").cast("string")
    card = F.concat(
        F.lit('<div class="views-row"><div class="search-index" data-history-node-id="'), number,
        F.lit('"><h2><a href="'), F.concat(F.lit("/fr/"), number),
        F.lit('"><span class="field--name-field-id">N-'), number, F.lit("</span> <b>"), "title",
        F.lit('</b></a></h2><div class="field--name-field-sector"><a>BTP</a><br><a> '),
        F.regexp_extract("url", r"^(\w+)", 1),
        F.lit(' </a></div><div class="search-index__footer"><p> Avis </p><time datetime="2026-07-17T12:00:00Z">'
              "17 juillet</time></div></div></div>"))
    return (
        rows.select(F.floor(F.col("page_id") / CARDS).alias("listing"), "page_id", card.alias("card"))
        .groupBy("listing").agg(F.array_sort(F.collect_list(F.struct("page_id", "card"))).alias("cards"))
        .select(F.col("listing").alias("page_id"), F.concat(
            F.lit("<html><body><p>liste</p>"),
            F.array_join(F.transform("cards", lambda c: c["card"]), "\n"), F.lit("</body></html>")).alias("html")))


@query("src_html_listing", """
SELECT CAST(floor(page_id / 20) AS BIGINT) AS page_id, 'N-' || CAST(page_id AS STRING) AS id_decision,
  'https://site.example.org/fr/' || CAST(page_id AS STRING) AS url, 'Avis' AS decision_type,
  DATE '2026-07-17' AS decision_date, 'BTP;' || regexp_extract(url, '^(\\w+)', 1) AS sectors,
  trim(regexp_replace(title, '[&<>;]', ' ', 'g'), ' ') AS title, CAST(page_id AS STRING) AS node_id
FROM v_listing
""")
def src_html_listing(spark, sf):
    parsed = listing.parse_listing(listing_pages(spark, sf), "https://site.example.org")
    return parsed.filter(F.col("error").isNull()).select(
        "page_id", "id_decision", "url", "decision_type", "decision_date",
        F.array_join("sectors", ";").alias("sectors"), "title", "node_id")


@query("src_bronze_scan", "SELECT external_id, payload FROM v_stored WHERE source = 'F'")
def src_bronze_scan(spark, sf):
    return bronze.scan_source(table(spark, sf, "v_stored"), "F")


@query("src_silver_snapshot", "SELECT source, count(*) AS n_rows, max(decision_date) AS last_date FROM v_decisions GROUP BY source")
def src_silver_snapshot(spark, sf):
    """Count and rows come from one immutable version folder."""
    root = work_dir(spark, "silver")
    rows = table(spark, sf, "v_decisions").select("source", "external_id", "decision_date", "text")
    path = publish.write_version(rows, root, "v1")
    version = bronze.read_version(spark, path, "source STRING, external_id STRING, decision_date DATE, text STRING")
    return version.groupBy("source").agg(F.count("*").alias("n_rows"), F.max("decision_date").alias("last_date"))


@query("src_external_id", """
SELECT p_partkey, CASE WHEN p_size = 50 THEN NULL
  ELSE 'https://decisions.example.org/' || CAST(p_partkey AS STRING) END AS external_id FROM part
""")
def src_external_id(spark, sf):
    return authority_records(spark, sf).select(
        "p_partkey", bronze.stable_id(F.col("external_id")).alias("external_id"))


@query("src_missing_id_counts", """
SELECT p_brand AS source, count(*) AS fetched, count(CASE WHEN p_size = 50 THEN 1 END) AS missing_id,
  count(CASE WHEN p_size <> 50 THEN 1 END) AS stored FROM part GROUP BY p_brand
""")
def src_missing_id_counts(spark, sf):
    ext = bronze.stable_id(F.col("external_id"))
    return authority_records(spark, sf).groupBy(F.col("p_brand").alias("source")).agg(
        F.count("*").alias("fetched"), F.count_if(ext.isNull()).alias("missing_id"), F.count(ext).alias("stored"))


@query("src_url_policy", r"""
WITH hosts AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) AS target FROM pages),
  ruled AS (SELECT DISTINCT host FROM hosts WHERE url LIKE 'https:%')
SELECT page_id, url FROM hosts
WHERE NOT (host IN (SELECT host FROM ruled) AND (target LIKE '%?%' OR target LIKE '%.html'))
""")
def src_url_policy(spark, sf):
    """Hosts seen over https forbid any query string and any page name; other hosts have no rules."""
    pages = source_table(spark, sf, "pages").select("page_id", "url")
    rules = pages.filter(F.col("url").startswith("https:")).select(
        host(F.col("url")).alias("host"), F.explode(F.array(F.lit("/*?"), F.lit("/*.html$"))).alias("pattern")).distinct()
    return policy.allowed_urls(pages, rules)


__all__ = ["landed_pages", "listing_pages", "sql_text"]
