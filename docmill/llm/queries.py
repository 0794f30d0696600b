"""One query per operator over its whole table, with production parameters, and its reference SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm import decontaminate, filter_audit, html_extraction, license_scan, lm_score, packing, quality_fm, quality_rules, secrets, simhash, token_codec, url_filter, whitening
from docmill.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_url_filters", url_filter.sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs.select("doc_id", "text"), model).drop("text")


@query("op10_benchmark_decontamination", decontaminate.SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("near_items", F.array_join("near_items", ","))


@query("op10_benchmark_proximity")
def op10_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with the items near each document as a list."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_secret_scans", secrets.sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query("op5_license_scans", license_scan.sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op4_token_output")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codec.round_trip(table(spark, sf_dir, "documents"))


@query("op1_lm_scoring")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


@query("op12_filter_interaction_audit", filter_audit.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), table(spark, sf_dir, "labels"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op11_html_extraction", html_extraction.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))
