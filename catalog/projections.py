"""Projections and transforms into the common schema (PRJ)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.payloads import (
    COURT_CODES, DATES, FLAGS, LISTS, NUMBERS, TEXTS, TYPES, authority_records, court_records, index,
)
from catalog.registry import pick, query
from catalog.sources import listing_pages
from catalog.views import AS_OF, now, table
from docmill.functions.display import display_title
from docmill.functions.text import has_text
from docmill.functions.variants import field, text_value
from docmill.model import DOCUMENT_FIELDS
from docmill.operators.polymorphic import with_fields, with_main_type
from docmill.plans import reports, silver
from docmill.sources.listing import listing_payload, parse_listing

_PART = {
    "type": pick([c[1] for c in TYPES], index("p_partkey", TYPES)),
    "subtypes": pick([c[2] for c in TYPES], index("p_partkey", TYPES)),
    "type_anomaly": pick([c[3] for c in TYPES], index("p_partkey", TYPES)),
    "number": pick([c[1] for c in TEXTS], index("p_size", TEXTS)),
    "date": pick([c[1] for c in DATES], index("p_partkey", DATES)),
    "sectors": pick([c[1] for c in LISTS], index("p_partkey", LISTS)),
    "sectors_null": pick([c[2] for c in LISTS], index("p_partkey", LISTS)),
    "companies": pick([c[1] for c in LISTS], index("p_partkey + p_size", LISTS)),
    "companies_null": pick([c[2] for c in LISTS], index("p_partkey + p_size", LISTS)),
    "flag": pick([c[1] for c in FLAGS], index("p_partkey", FLAGS)),
    "flag_bad": pick([c[2] for c in FLAGS], index("p_partkey", FLAGS)),
}
_URL = "'https://decisions.example.org/' || CAST(p_partkey AS STRING)"
_CUST = {
    "number": pick([c[1] for c in NUMBERS], index("c_custkey", NUMBERS)),
    "issuer": pick([c[1] for c in COURT_CODES], index("c_custkey", COURT_CODES)),
    "date": pick([c[1] for c in DATES], index("c_custkey", DATES)),
}
# All anomalies of a row, in one place for the counts below.
_ANOMALIES = f"""
  a AS (
    SELECT 'authority' AS source, unnest(CASE WHEN p_size = 50 THEN ['missing_external_id'] ELSE list_filter([
      {_PART['type_anomaly']}, CASE WHEN {_PART['date']} IS NULL THEN 'invalid_decision_date' END,
      CASE WHEN {_PART['sectors']} IS NULL AND NOT {_PART['sectors_null']} THEN 'malformed_sectors' END,
      CASE WHEN {_PART['companies']} IS NULL AND NOT {_PART['companies_null']} THEN 'malformed_entreprises' END,
      CASE WHEN {_PART['flag_bad']} THEN 'invalid_decision_simplifiee' END], lambda x: x IS NOT NULL) END) AS kind FROM part
    UNION ALL
    SELECT 'court' AS source, unnest(CASE WHEN c_nationkey = 24 THEN ['missing_external_id'] ELSE list_filter([
      CASE WHEN {_CUST['number']} IS NULL THEN 'invalid_decision_number' END,
      CASE WHEN {_CUST['issuer']} IS NULL THEN 'unknown_jurisdiction' END,
      CASE WHEN {_CUST['date']} IS NULL THEN 'invalid_decision_date' END], lambda x: x IS NOT NULL) END) AS kind FROM customer)
"""
REGISTRY = {"authority": silver.authority("authority"), "court": silver.court("court")}


def raw_layer(spark, sf):
    """Both payload families in one stored layer."""
    a = authority_records(spark, sf).select(F.lit("authority").alias("source"), "external_id", "payload")
    c = court_records(spark, sf).select(F.lit("court").alias("source"), "external_id", "payload")
    return a.unionByName(c)


def transformed(spark, sf):
    return silver.transform_all(raw_layer(spark, sf), REGISTRY)


@query("prj_court_to_silver", f"""
SELECT 'court' AS source, c_name AS external_id, {_CUST['number']} AS decision_number, {_CUST['issuer']} AS issuer,
  CAST(NULL AS STRING) AS decision_type, CAST({_CUST['date']} AS DATE) AS decision_date, CAST(NULL AS STRING) AS title,
  c_mktsegment AS text, 0 AS n_sectors, 'https://www.courdecassation.fr/decision/' || c_name AS url
FROM customer WHERE c_nationkey <> 24
""")
def prj_court_to_silver(spark, sf):
    rows = silver.court("court")(court_records(spark, sf).select("external_id", "payload"))
    return silver.silver_rows(rows, now()).select(
        "source", "external_id", "decision_number", "issuer", "decision_type", "decision_date", "title", "text",
        F.size("sectors").alias("n_sectors"), "url")


@query("prj_authority_to_silver", f"""
SELECT 'authority' AS source, {_URL} AS external_id, {_PART['number']} AS decision_number,
  'Autorité de la concurrence' AS issuer, {_PART['type']} AS decision_type,
  CAST({_PART['date']} AS DATE) AS decision_date, p_name AS title, ' ' || p_type || ' ' AS text,
  coalesce({_PART['sectors']}, '') AS sectors, {_URL} AS url
FROM part WHERE p_size <> 50
""")
def prj_authority_to_silver(spark, sf):
    rows = silver.authority("authority")(authority_records(spark, sf).select("external_id", "payload"))
    return silver.silver_rows(rows, now()).select(
        "source", "external_id", "decision_number", "issuer", "decision_type", "decision_date", "title", "text",
        F.array_join("sectors", ";").alias("sectors"), "url")


@query("prj_first_valid_number", f"SELECT c_custkey, {_CUST['number']} AS decision_number FROM customer")
def prj_first_valid_number(spark, sf):
    rows = court_records(spark, sf).select("c_custkey", F.try_parse_json("payload").alias("v"))
    return rows.select("c_custkey", silver.first_valid_number(field(F.col("v"), "numbers")).alias("decision_number"))


@query("prj_type_parse", f"""
SELECT p_partkey, {_PART['type']} AS decision_type, {_PART['subtypes']} AS subtypes, {_PART['type_anomaly']} AS anomaly
FROM part
""")
def prj_type_parse(spark, sf):
    rows = authority_records(spark, sf).select("p_partkey", F.try_parse_json("payload").alias("v"))
    rows = with_fields(rows, "v", {"f": "type_decision"})
    rows = with_main_type(rows, "f", silver.AUTHORITY_TYPES, ("decision_type", "items", "anomaly"))
    return rows.select("p_partkey", "decision_type", F.array_join("items", ";").alias("subtypes"), "anomaly")


@query("prj_code_lookup", f"""
SELECT c_custkey, {_CUST['issuer']} AS issuer,
  CASE WHEN {_CUST['issuer']} IS NULL THEN 'unknown_jurisdiction' END AS anomaly FROM customer
""")
def prj_code_lookup(spark, sf):
    rows = court_records(spark, sf).select("c_custkey", F.try_parse_json("payload").alias("v"))
    issuer = silver.code_label(text_value(field(F.col("v"), "jurisdiction")), silver.COURTS)
    return rows.select("c_custkey", issuer.alias("issuer"),
                       F.when(issuer.isNull(), "unknown_jurisdiction").alias("anomaly"))


@query("prj_attributes_open", f"""
SELECT {_URL} AS external_id, trim(p_brand, ' ') AS marque, p_size AS taille, {_PART['subtypes']} AS subtypes,
  CASE WHEN {_PART['companies_null']} THEN NULL ELSE coalesce({_PART['companies']}, '') END AS companies,
  {_PART['flag']} AS flag, FALSE AS has_title
FROM part WHERE p_size <> 50
""")
def prj_attributes_open(spark, sf):
    """Every field without a column stays, cleaned; read back from the attribute JSON."""
    rows = silver.authority("authority")(authority_records(spark, sf).select("external_id", "payload"))
    v = F.col("v")
    return rows.filter(F.col("external_id").isNotNull()).select(
        "external_id", F.parse_json("attributes").alias("v")).select(
        "external_id", F.try_variant_get(v, "$.marque", "string").alias("marque"),
        F.try_variant_get(v, "$.taille", "int").alias("taille"),
        F.array_join(F.try_variant_get(v, "$.subtypes", "array<string>"), ";").alias("subtypes"),
        F.array_join(F.try_variant_get(v, "$.entreprises_concernees", "array<string>"), ";").alias("companies"),
        F.try_variant_get(v, "$.decision_simplifiee", "boolean").cast("string").alias("flag"),
        field(v, "titre_decision").isNotNull().alias("has_title"))


@query("prj_attributes_fixed", f"""
SELECT c_name AS external_id, '{{"chamber":null,"ecli":null,"formation":null,"numbers":' ||
  {pick(['["26-83.146","19-24.008"]', '["19-24.008"]', '["19-24.00820"]', '[]', 'null', '[12]', '"26-83.146"'],
        index('c_custkey', NUMBERS))} ||
  ',"publication":null,"solution":null,"source_type":"other",' ||
  {pick(['"summary":"  C2007/14 ",', '', '', '', '"summary":" x ",'], index('c_nationkey', TEXTS))} ||
  '"themes":["' || c_mktsegment || '"],"update_date":null}}' AS attributes
FROM customer WHERE c_nationkey <> 24
""")
def prj_attributes_fixed(spark, sf):
    rows = silver.court("court")(court_records(spark, sf).select("external_id", "payload"))
    return rows.filter(F.col("external_id").isNotNull()).select("external_id", "attributes")


@query("prj_build_rows_counts", """
SELECT 'authority' AS source, count(*) AS n_read, count(CASE WHEN p_size <> 50 THEN 1 END) AS n_written,
  count(CASE WHEN p_size = 50 THEN 1 END) AS n_skipped FROM part
UNION ALL
SELECT 'court', count(*), count(CASE WHEN c_nationkey <> 24 THEN 1 END), count(CASE WHEN c_nationkey = 24 THEN 1 END)
FROM customer
""")
def prj_build_rows_counts(spark, sf):
    return silver.row_counts(transformed(spark, sf))


@query("prj_anomaly_counts", f"WITH {_ANOMALIES} SELECT source, kind, count(*) AS n FROM a GROUP BY source, kind")
def prj_anomaly_counts(spark, sf):
    return silver.anomaly_counts(transformed(spark, sf))


@query("prj_search_document", f"""
SELECT source || '|' || external_id AS doc_id, source, external_id, decision_number, issuer, decision_type,
  CAST(decision_date AS STRING) AS decision_date, title, text, regexp_matches(text, '[^\\s]') AS has_text, sectors_text AS sectors,
  url, attributes, '{AS_OF}' AS indexed_at
FROM v_decisions
""")
def prj_search_document(spark, sf):
    docs = table(spark, sf, "v_decisions").withColumn("has_text", has_text(F.col("text"))).withColumn(
        "decision_date", F.col("decision_date").cast("string")).withColumn("indexed_at", F.lit(AS_OF))
    return docs.withColumn("sectors", F.array_join("sectors", "|")).select(
        F.concat_ws("|", "source", "external_id").alias("doc_id"), *DOCUMENT_FIELDS)


@query("prj_listing_payload", """
SELECT page_id AS node, '{"id_decision":"N-' || page_id || '","title":"' || trim(regexp_replace(title, '[&<>;]', ' ', 'g'), ' ')
  || '","url":"https://site.example.org/fr/' || page_id || '","decision_type":"Avis","decision_date":"2026-07-17","sectors":["BTP","'
  || regexp_extract(url, '^(\\w+)', 1) || '"],"node_id":"' || page_id || '"}' AS payload
FROM v_listing
""")
def prj_listing_payload(spark, sf):
    rows = parse_listing(listing_pages(spark, sf), "https://site.example.org")
    return rows.select(F.col("node_id").cast("bigint").alias("node"), listing_payload().alias("payload"))


_MONTHS = ("['janvier','février','mars','avril','mai','juin','juillet','août','septembre','octobre','novembre',"
           "'décembre']")
DISPLAY = f"""CASE WHEN regexp_matches(coalesce(title, ''), '[^\\s]') THEN title ELSE coalesce(nullif(concat_ws(', ', issuer,
  CASE WHEN decision_date IS NOT NULL THEN CASE WHEN day(decision_date) = 1 THEN '1er' ELSE CAST(day(decision_date) AS STRING)
  END || ' ' || list_extract({_MONTHS}, month(decision_date)) || ' ' || year(decision_date) END,
  'n° ' || decision_number), ''), 'Décision ' || external_id) END"""


@query("prj_hit_fields", f"""
SELECT source, external_id, decision_number, issuer, decision_type, decision_date, title, {DISPLAY} AS display_title,
  sectors_text AS sectors, url, regexp_matches(text, '[^\\s]') AS has_text,
  '/decisions/' || source || '?id=' || replace(replace(url, ':', '%3A'), '/', '%2F') AS detail_path
FROM v_decisions
""")
def prj_hit_fields(spark, sf):
    """The address serves as identifier in the link, so that it needs encoding."""
    docs = table(spark, sf, "v_decisions").withColumn("has_text", has_text(F.col("text")))
    hits = reports.hit_fields(docs)
    return hits.withColumn("sectors", F.array_join("sectors", "|")).withColumn(
        "detail_path", reports.detail_path(F.col("source"), F.col("url")))


@query("prj_display_title", f"SELECT doc_id, {DISPLAY} AS display_title FROM v_decisions")
def prj_display_title(spark, sf):
    return table(spark, sf, "v_decisions").select("doc_id", display_title(
        F.col("title"), F.col("issuer"), F.col("decision_date"), F.col("decision_number"),
        F.col("external_id")).alias("display_title"))
