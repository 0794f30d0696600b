"""Landed JSON: array snapshots, cursor-paged batches, records without identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions.variants import canonical_json, field, strip_text

PAGE_SCHEMA = "scan STRING, page BIGINT, next_batch STRING, results ARRAY<VARIANT>"


def read_array_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Elements of JSON array files; polymorphic fields are declared VARIANT in the schema.

    Schema inference is never used: a field that is a string here and a list there would be
    read as text. An array file is one task: for many small files. ``json_arrays`` reads large ones by many tasks.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One record per line, each wholly in the variant column ``v``."""
    return spark.read.option("singleVariantColumn", "v").json(path)


def page_records(pages: DataFrame) -> DataFrame:
    """Records of landed pages in cursor order; a scan ends at its first empty page or at the
    first page without a cursor (whose own records still count)."""
    ends = F.col("next_batch").isNull() | (F.col("next_batch") == "") | (
        F.coalesce(F.size("results"), F.lit(0)) <= 0
    )
    stops = pages.groupBy("scan").agg(F.min(F.when(ends, F.col("page"))).alias("_stop"))
    return (
        pages.join(stops, "scan")
        .filter(F.col("_stop").isNull() | (F.col("page") <= F.col("_stop")))
        .select("scan", "page", F.posexplode("results").alias("pos", "v"))
        # Positions are 32-bit, so pages never overlap, however many records one holds.
        .withColumn("seq", F.shiftleft(F.col("page"), 32) + F.col("pos"))
    )


def to_batch(records: DataFrame, source: str | Column, id_field: str, trim: bool = True) -> DataFrame:
    """Upsert batch out of variant records: identifier, canonical payload, hash."""
    identifier = strip_text(field(F.col("v"), id_field)) if trim else F.nullif(
        F.try_variant_get(F.col("v"), f"$.{id_field}", "string"), F.lit(""))
    payload = F.to_json("v")
    return records.select(
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        identifier.alias("external_id"),
        "seq",
        payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_hash"),
    )


def split_missing_id(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to store, rows only counted)."""
    return batch.filter(F.col("external_id").isNotNull()), batch.filter(F.col("external_id").isNull())


def quarantine(raw: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(readable rows, rows whose payload is not JSON or repeats a key)."""
    canonical = canonical_json(F.col(payload))
    return raw.filter(canonical.isNotNull()), raw.filter(canonical.isNull())
