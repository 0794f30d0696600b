"""Scalar functions (FN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.payloads import DATES, LISTS, TEXTS, authority_records, index
from catalog.registry import pick, query
from catalog.views import AS_OF, now, source_table, table
from docmill.functions import dates, text, urls, variants

SPACE = r"[\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_sql(value: str) -> str:
    return f"regexp_replace({value}, '^{SPACE}+|{SPACE}+$', '', 'g')"




def fold_sql(value: str) -> str:
    return f"replace(strip_accents(lower({value})), 'ß', 'ss')"


def payload_field(spark, sf, name):
    return authority_records(spark, sf).select(
        "p_partkey", variants.field(F.try_parse_json("payload"), name).alias("v"))


@query("fn_strip_or_none", f"SELECT p_partkey, {pick([c[1] for c in TEXTS], index('p_size', TEXTS))} AS value FROM part")
def fn_strip_or_none(spark, sf):
    return payload_field(spark, sf, "id_decision").select("p_partkey", variants.strip_text(F.col("v")).alias("value"))


@query("fn_strip_text", f"""
SELECT doc_id, nullif({strip_sql("chr(160) || chr(9) || text || chr(8195)")}, '') AS value FROM v_decisions
""")
def fn_strip_text(spark, sf):
    padded = F.concat(F.lit(" \t"), "text", F.lit(" "))
    return table(spark, sf, "v_decisions").select("doc_id", text.strip_or_none(padded).alias("value"))


@query("fn_parse_iso_date", f"""
SELECT p_partkey, CAST({pick([c[1] for c in DATES], index('p_partkey', DATES))} AS DATE) AS value FROM part
""")
def fn_parse_iso_date(spark, sf):
    rows = payload_field(spark, sf, "date_decision_datetime")
    return rows.select("p_partkey", dates.parse_iso_date(variants.text_value(F.col("v"))).alias("value"))


_IS_TEXT = [c[1] if c[0].startswith('"') else None for c in LISTS]
_IS_LIST = [c[1] if c[0].startswith("[") else None for c in LISTS]


@query("fn_parse_python_list", f"SELECT p_partkey, {pick(_IS_TEXT, index('p_partkey', LISTS))} AS value FROM part")
def fn_parse_python_list(spark, sf):
    rows = payload_field(spark, sf, "secteur_activite")
    items = variants.parse_list_text(variants.text_value(F.col("v")), escapes=True)
    return rows.select("p_partkey", F.array_join(items, ";").alias("value"))


@query("fn_clean_str_list", f"SELECT p_partkey, {pick(_IS_LIST, index('p_partkey', LISTS))} AS value FROM part")
def fn_clean_str_list(spark, sf):
    rows = payload_field(spark, sf, "secteur_activite")
    return rows.select("p_partkey", F.array_join(variants.clean_str_list(F.col("v")), ";").alias("value"))


@query("fn_parse_str_list", f"SELECT p_partkey, {pick([c[1] for c in LISTS], index('p_partkey', LISTS))} AS value FROM part")
def fn_parse_str_list(spark, sf):
    rows = payload_field(spark, sf, "secteur_activite")
    return rows.select("p_partkey", F.array_join(variants.parse_str_list(F.col("v"), True), ";").alias("value"))


@query("fn_array_dedupe", """
WITH w AS (SELECT doc_id, word, min(i) AS first FROM (
    SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents) x
  GROUP BY doc_id, word)
SELECT doc_id, count(*) AS n, md5(string_agg(word, ' ' ORDER BY first)) AS words FROM w GROUP BY doc_id
""")
def fn_array_dedupe(spark, sf):
    words = F.array_distinct(F.split("text", " "))
    return source_table(spark, sf, "documents").select(
        "doc_id", F.size(words).cast("bigint").alias("n"), F.md5(F.array_join(words, " ")).alias("words"))


@query("fn_has_text", f"""
SELECT doc_id, regexp_matches(text, '[^\\s]') AS has_text,
  regexp_matches({strip_sql("replace(text, ' ', chr(160))")}, '.') AS has_text_nbsp FROM v_decisions
""")
def fn_has_text(spark, sf):
    nbsp = F.replace(F.col("text"), F.lit(" "), F.lit(" "))
    return table(spark, sf, "v_decisions").select(
        "doc_id", text.has_text(F.col("text")).alias("has_text"), text.has_text(nbsp).alias("has_text_nbsp"))


@query("fn_sql_blank", "SELECT doc_id, text IS NULL OR trim(text, ' ') = '' AS blank FROM v_decisions")
def fn_sql_blank(spark, sf):
    return table(spark, sf, "v_decisions").select("doc_id", text.is_sql_blank(F.col("text")).alias("blank"))


@query("fn_normalize_url", "SELECT page_id, rtrim(url || '//', '/') AS url FROM pages")
def fn_normalize_url(spark, sf):
    padded = F.concat(F.lit(" "), "url", F.lit("// "))
    return source_table(spark, sf, "pages").select("page_id", urls.normalize_url(padded).alias("url"))


# Every link as it stands, and once more behind a dot segment of its page's folder.
@query("fn_url_join", r"""
WITH links AS (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages),
  every AS (SELECT page_id, url, link, link AS plain FROM links UNION ALL
    SELECT page_id, url, './x/../' || link, link FROM links WHERE NOT regexp_matches(link, '^[/#?]|^[A-Za-z][A-Za-z0-9+.-]*:') AND link <> '')
SELECT page_id, link, CASE WHEN plain = '' THEN url WHEN regexp_matches(plain, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN plain
  WHEN plain LIKE '//%' THEN split_part(url, '//', 1) || plain
  WHEN plain LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || plain
  WHEN plain LIKE '#%' THEN split_part(url, '#', 1) || plain WHEN plain LIKE '?%' THEN regexp_extract(url, '^[^?#]*') || plain
  ELSE regexp_extract(url, '^([a-z]+://[^?#]*/)', 1) || plain END AS target
FROM every
""")
def fn_url_join(spark, sf):
    links = source_table(spark, sf, "pages").select(
        "page_id", "url", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    relative = links.filter("link <> ''").filter(~F.col("link").rlike("^[/#?]|^[A-Za-z][A-Za-z0-9+.-]*:"))
    both = links.unionByName(relative.withColumn("link", F.concat(F.lit("./x/../"), "link")))
    return both.select("page_id", "link", urls.absolute_url(F.col("url"), F.col("link")).alias("target"))


@query("fn_title_key", f"""
SELECT doc_id, nullif(replace({strip_sql("' ' || title || ' l’eau '")}, '’', ''''), '') AS title_key FROM v_decisions
""")
def fn_title_key(spark, sf):
    padded = F.concat(F.lit(" "), "title", F.lit(" l’eau "))
    return table(spark, sf, "v_decisions").select("doc_id", text.title_key(padded).alias("title_key"))


@query("fn_number_key", "SELECT doc_id, nullif(lower(trim(decision_number, ' ')), '') AS number_key FROM v_decisions")
def fn_number_key(spark, sf):
    return table(spark, sf, "v_decisions").select("doc_id", text.number_key(F.col("decision_number")).alias("number_key"))


@query("fn_fold_keyword", f"SELECT doc_id, md5({fold_sql('text')}) AS folded FROM documents")
def fn_fold_keyword(spark, sf):
    return source_table(spark, sf, "documents").select("doc_id", F.md5(text.fold_keyword(F.col("text"))).alias("folded"))


@query("fn_two_digit_year", """
SELECT doc_id, CAST(substring(decision_number, 1, 2) AS INT)
  + CASE WHEN CAST(substring(decision_number, 1, 2) AS INT) >= 87 THEN 1900 ELSE 2000 END AS number_year FROM v_decisions
""")
def fn_two_digit_year(spark, sf):
    return table(spark, sf, "v_decisions").select(
        "doc_id", dates.number_year(F.col("decision_number")).alias("number_year"))


@query("fn_elapsed", f"""
SELECT run_id, CAST(epoch_us(finished_at) - epoch_us(started_at) AS DOUBLE) / 1000000 AS seconds,
  round(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(finished_at) AS DOUBLE) / 1000000 / 3600) + 0.0 AS hours FROM v_runs
""")
def fn_elapsed(spark, sf):
    return table(spark, sf, "v_runs").select(
        "run_id", dates.elapsed_seconds(F.col("finished_at"), F.col("started_at")).alias("seconds"),
        F.round(dates.elapsed_hours(now(), F.col("finished_at"))).alias("hours"))


@query("fn_json_field", "SELECT doc_id, json_extract_string(attributes, '$.ecli') AS ecli FROM v_decisions")
def fn_json_field(spark, sf):
    return table(spark, sf, "v_decisions").select("doc_id", F.get_json_object("attributes", "$.ecli").alias("ecli"))


@query("fn_expectation_parts", r"""
SELECT l_orderkey, l_linenumber, split_part(e, ' ', 1) AS op,
  CAST(CAST(nullif(regexp_extract(e, '-?[0-9]+(?:\.[0-9]+)?', 0), '') AS DECIMAL(38,10)) AS DOUBLE) AS bound
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN '== '
        WHEN l_linestatus = 'O' THEN '<= -' ELSE '>= ' END || CAST(CAST(l_discount AS DECIMAL(5,2)) AS STRING) AS e
      FROM lineitem) x
""")
def fn_expectation_parts(spark, sf):
    op = F.when(F.col("l_returnflag") == "R", "== ").when(F.col("l_linestatus") == "O", "<= -").otherwise(">= ")
    e = F.concat(op, F.col("l_discount").cast("decimal(5,2)").cast("string"))
    return source_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text.expectation_operator(e).alias("op"),
        text.expectation_bound(e).cast("double").alias("bound"))


@query("fn_number_label", """
SELECT l_orderkey, l_linenumber, rtrim(rtrim(CAST(CAST(l_quantity * (1 - l_discount) AS DECIMAL(12,2)) AS STRING), '0'), '.')
  AS label FROM lineitem
""")
def fn_number_label(spark, sf):
    value = (F.col("l_quantity") * (1 - F.col("l_discount"))).cast("decimal(12,2)")
    return source_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text.number_label(value).alias("label"))


@query("fn_date_format", "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS day FROM orders")
def fn_date_format(spark, sf):
    return source_table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"))


@query("fn_md5_key", "SELECT doc_id, md5(external_id) AS sample_key FROM v_decisions")
def fn_md5_key(spark, sf):
    return table(spark, sf, "v_decisions").select("doc_id", F.md5("external_id").alias("sample_key"))
