"""Scans of stored layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions.text import strip_or_none


def scan_source(raw: DataFrame, source: str) -> DataFrame:
    """Documents of one source: the filter prunes partitions and row groups of the scan."""
    return raw.filter(F.col("source") == source).select("external_id", "payload")


def write_raw(raw: DataFrame, path: str) -> None:
    """Stored layer laid out by source, so a scan of one source reads only its folder.

    Rows stay spread by key: a source holding most rows still writes from every task.
    """
    raw.write.mode("errorifexists").partitionBy("source").option(
        "maxRecordsPerFile", 1_000_000).parquet(path)


def read_version(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Immutable version folder: its count and its rows always agree."""
    return spark.read.schema(schema).parquet(path)


def stable_id(url: Column) -> Column:
    """External identifier: the trimmed address, NULL when blank (numbers are not unique)."""
    return strip_or_none(url)
