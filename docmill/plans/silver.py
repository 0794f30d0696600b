"""Per-source transforms into the common schema, and the registry of sources.

A transform maps ``external_id, payload`` to the common columns plus ``anomalies``; rows without
identifier are marked (``external_id`` NULL) so that they are counted before being skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.dates import parse_iso_date
from docmill.functions.text import strip, strip_or_none
from docmill.functions.variants import EMPTY_LIST, field, kind, strip_text, text_value, yes_no
from docmill.operators.layout import explode_once
from docmill.operators.polymorphic import with_fields, with_main_type, with_str_lists

Transform = Callable[[DataFrame], DataFrame]

# Vocabularies and formats of the two payload families.
COURTS = {"cc": "Cour de cassation", "ca": "Cour d'appel", "tj": "Tribunal judiciaire"}
COURT_NUMBER = r"\A\d{2}-\d{2}\.\d{3}\z"
COURT_URL = "https://www.courdecassation.fr/decision/"
COURT_ATTRIBUTES = ("ecli", "chamber", "formation", "solution", "publication", "themes")
AUTHORITY_ISSUER = "Autorité de la concurrence"
AUTHORITY_TYPES = {
    "Décision": "decision",
    "Avis": "avis",
    "DCC": "concentration",
    "Lettre du minsitre de l'économie": "lettre_ministre",
}
AUTHORITY_COLUMNS = (
    "id_decision", "type_decision", "date_decision_datetime", "titre_decision",
    "texte_complet_decision", "secteur_activite", "url_site",
)
COMPANIES, SIMPLIFIED = "entreprises_concernees", "decision_simplifiee"
YES, NO = "Oui", "Non"
COLUMNS = (
    "source", "external_id", "decision_number", "issuer", "decision_type", "decision_date",
    "title", "text", "sectors", "url", "attributes", "anomalies",
)
NULL_VARIANT = "parse_json('null')"


def _anomalies(external_id: Column, *items: Column) -> Column:
    found = F.array_compact(F.array(*items))
    return F.when(external_id.isNull(), F.array(F.lit("missing_external_id"))).otherwise(found)


def _missing(value: Column, name: str) -> Column:
    return F.when(value.isNull(), F.lit(name))


def first_valid_number(numbers: Column) -> Column:
    """First entry of a list when it has the number format; a later entry is never taken."""
    first = text_value(F.try_variant_get(numbers, "$[0]", "variant"))
    return F.when(first.rlike(COURT_NUMBER), first)


def code_label(code: Column, labels: Mapping[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.try_element_at(table, code)


def distinct_list(v: Column) -> Column:
    """Repeats removed in first-seen order when the list holds strings; other values as they are."""
    items = F.try_variant_get(v, "$", "array<string>")
    texts = (kind(v) == "ARRAY<STRING>") & ~F.exists(items, lambda x: x.isNull())
    return F.when(texts, F.to_variant_object(F.array_distinct(items))).otherwise(v)


def fixed_attributes(v: Column, type_attribute: str = "source_type") -> Column:
    """Fixed subset of the payload: missing fields are null, the summary only when non-blank."""
    null = F.expr(NULL_VARIANT)
    parts = {name: field(v, name) for name in COURT_ATTRIBUTES}
    parts["numbers"] = distinct_list(field(v, "numbers"))
    parts["update_date"] = field(v, "update_date")
    parts[type_attribute] = field(v, "type")
    entries = [x for name, c in parts.items() for x in (F.lit(name), F.coalesce(c, null))]
    summary = field(v, "summary")
    base = F.create_map(*entries)
    full = F.when(
        strip_text(summary).isNotNull(), F.map_concat(base, F.create_map(F.lit("summary"), summary))
    ).otherwise(base)
    return F.to_json(F.to_variant_object(full))


def open_attributes(doc: Column, companies: Column, flag: Column, subtypes: Column) -> Column:
    """JSON of every payload field without a column of its own: strings trimmed, the company list
    and the yes/no field replaced by their parsed values, the rest as it is."""
    null = F.expr(NULL_VARIANT)

    def clean(name: Column, value: Column) -> Column:
        return (
            F.when(name == COMPANIES, F.when(F.is_variant_null(value), null).otherwise(
                F.to_variant_object(F.coalesce(companies, EMPTY_LIST()))))
            .when(name == SIMPLIFIED, F.coalesce(flag.cast("variant"), null))
            .when(kind(value) == "STRING", strip(text_value(value)).cast("variant"))
            .otherwise(value)
        )

    fields = F.try_variant_get(doc, "$", "map<string,variant>")
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*AUTHORITY_COLUMNS, "subtypes"))
    extra = F.create_map(F.lit("subtypes"), F.to_variant_object(subtypes))
    return F.to_json(F.to_variant_object(F.map_concat(F.transform_values(kept, clean), extra)))


def court(source: str, url_prefix: str = COURT_URL,
          type_attribute: str = "source_type") -> Transform:
    """Court decisions: no type, no title, no sectors; the address follows a template."""

    def transform(raw: DataFrame) -> DataFrame:
        v, ext = F.col("v"), F.col("ext")
        rows = raw.select(
            F.try_parse_json("payload").alias("v"), strip_or_none(F.col("external_id")).alias("ext"))
        rows = rows.withColumns({
            "number": first_valid_number(field(v, "numbers")),
            "issuer": code_label(text_value(field(v, "jurisdiction")), COURTS),
            "decided": parse_iso_date(text_value(field(v, "decision_date"))),
        })
        none = F.lit(None).cast("string")
        return rows.select(
            F.lit(source).alias("source"), ext.alias("external_id"),
            F.col("number").alias("decision_number"), "issuer", none.alias("decision_type"),
            F.col("decided").alias("decision_date"), none.alias("title"),
            text_value(field(v, "text")).alias("text"), EMPTY_LIST().alias("sectors"),
            F.concat(F.lit(url_prefix), ext).alias("url"),
            fixed_attributes(v, type_attribute).alias("attributes"),
            _anomalies(
                ext, _missing(F.col("number"), "invalid_decision_number"),
                _missing(F.col("issuer"), "unknown_jurisdiction"),
                _missing(F.col("decided"), "invalid_decision_date"),
            ).alias("anomalies"),
        )

    return transform


def authority(source: str, issuer: str = AUTHORITY_ISSUER,
              labels: Mapping[str, str] = AUTHORITY_TYPES) -> Transform:
    """Authority decisions: polymorphic type and lists, every other field kept as attribute."""

    def transform(raw: DataFrame) -> DataFrame:
        rows = raw.select(
            F.try_parse_json("payload").alias("v"), strip_or_none(F.col("external_id")).alias("ext"))
        rows = with_fields(rows, "v", {
            "f_type": "type_decision", "f_date": "date_decision_datetime", "f_sectors": "secteur_activite",
            "f_companies": COMPANIES, "f_flag": SIMPLIFIED,
        })
        rows = with_str_lists(rows, {"f_sectors": "sector_list", "f_companies": "company_list"})
        rows = with_main_type(rows, "f_type", labels, ("label", "subtypes", "type_anomaly"))
        rows = rows.withColumns({
            "decided": parse_iso_date(F.col("f_date_t")), "flag": yes_no(F.col("f_flag_t"), YES, NO)})
        ext, v = F.col("ext"), F.col("v")
        bad = lambda f, value, name: F.when(
            (F.col(f"{f}_k") != "VOID") & F.col(value).isNull(), F.lit(name))
        return rows.select(
            F.lit(source).alias("source"), ext.alias("external_id"),
            strip_text(field(v, "id_decision")).alias("decision_number"),
            F.lit(issuer).alias("issuer"), F.col("label").alias("decision_type"),
            F.col("decided").alias("decision_date"),
            strip_text(field(v, "titre_decision")).alias("title"),
            text_value(field(v, "texte_complet_decision")).alias("text"),
            F.coalesce("sector_list", EMPTY_LIST()).alias("sectors"),
            strip_text(field(v, "url_site")).alias("url"),
            open_attributes(v, F.col("company_list"), F.col("flag"), F.col("subtypes")).alias("attributes"),
            _anomalies(
                ext, F.col("type_anomaly"), _missing(F.col("decided"), "invalid_decision_date"),
                bad("f_sectors", "sector_list", "malformed_sectors"),
                bad("f_companies", "company_list", "malformed_entreprises"),
                bad("f_flag", "flag", "invalid_decision_simplifiee"),
            ).alias("anomalies"),
        )

    return transform


def transform_all(raw: DataFrame, registry: Mapping[str, Transform]) -> DataFrame:
    """Registered sources side by side: a union, never merged or de-duplicated across sources."""
    parts = [
        fn(raw.filter(F.col("source") == name).select("external_id", "payload"))
        for name, fn in registry.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def silver_rows(transformed: DataFrame, built_at: Column) -> DataFrame:
    """Rows to store: only those without identifier are skipped."""
    return (
        transformed.filter(F.col("external_id").isNotNull()).drop("anomalies")
        .withColumn("built_at", built_at)
    )


def row_counts(transformed: DataFrame) -> DataFrame:
    return transformed.groupBy("source").agg(
        F.count("*").alias("n_read"),
        F.count("external_id").alias("n_written"),
        F.count_if(F.col("external_id").isNull()).alias("n_skipped"),
    )


def anomaly_counts(transformed: DataFrame) -> DataFrame:
    kinds = explode_once(transformed, ["source"], F.col("anomalies"), "kind")
    return kinds.groupBy("source", "kind").agg(F.count("*").alias("n"))
