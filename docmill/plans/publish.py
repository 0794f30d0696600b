"""Versioned publication: write a new version, compare counts, publish only when they agree.

A version is an immutable folder. Publishing appends one row to a small versions table; readers
resolve the last published row once and then read that folder only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.operators.keys import merge_counts
from docmill.operators.ranking import top_k_per_group
from docmill.session import written

VERSIONS = "dataset STRING, version STRING, path STRING, published_at TIMESTAMP"
# Fixed value: version names are the dataset name and a UTC moment.
VERSION_PATTERN = r"\A[a-z]+_\d{8}_\d{6}\z"


def write_version(df: DataFrame, root: str, version: str) -> str:
    """Write a folder that nobody reads yet; a failure leaves every published version untouched."""
    path = f"{root}/{version}"
    df.write.mode("errorifexists").option("maxRecordsPerFile", 1_000_000).parquet(path)
    return path


def publish(spark: SparkSession, versions_path: str, dataset: str, version: str, path: str,
            published_at: Column) -> None:
    row = spark.range(1).select(
        F.lit(dataset).alias("dataset"), F.lit(version).alias("version"), F.lit(path).alias("path"),
        published_at.alias("published_at"))
    row.write.mode("append").parquet(versions_path)


def current_path(spark: SparkSession, versions_path: str, dataset: str) -> str:
    """Folder of the last published version (a single row reaches the driver)."""
    row = (
        spark.read.schema(VERSIONS).parquet(versions_path).filter(F.col("dataset") == dataset)
        .orderBy(F.desc("published_at"), F.desc("version")).first()
    )
    if row is None:
        raise ValueError(f"{dataset} was never published")
    return row["path"]


def gate_rows(expected: DataFrame, indexed: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per source: expected, indexed and rejected counts, and whether they allow publication."""
    return merge_counts({"expected": expected, "indexed": indexed, "rejected": rejected}).withColumn(
        "accepted", (F.col("expected") == F.col("indexed")) & (F.col("rejected") == 0))


def gate(rows: DataFrame) -> DataFrame:
    """One row: publish only a non-empty set whose sources all agree, with the reason if not: each
    source that disagrees, with its three counts (there are as many as sources, a handful)."""
    told = F.concat_ws(
        " ", "source", F.concat(F.lit("(expected "), F.col("expected").cast("string"), F.lit(", indexed "),
                                F.col("indexed").cast("string"), F.lit(", rejected "), F.col("rejected").cast("string"), F.lit(")")))
    named = F.array_join(F.array_sort(F.collect_list(F.when(~F.col("accepted"), told))), "; ")
    bad = F.count_if(~F.col("accepted"))
    total = F.coalesce(F.sum("expected"), F.lit(0))
    return rows.agg(
        ((total > 0) & (bad == 0)).alias("publish"), total.alias("n_expected"),
        bad.alias("n_mismatched"),
        F.when(total == 0, "nothing to publish")
        .when(bad > 0, F.concat(F.lit("counts differ: "), named))
        .alias("reason"),
    )


def rebuild(spark: SparkSession, documents: DataFrame, expected: DataFrame, rejected: DataFrame,
            root: str, dataset: str, version: str, now: Column) -> DataFrame:
    """Build, count, gate and publish; returns the gate rows with the outcome. A refused version's
    folder is deleted; readers never saw it."""
    path = write_version(documents, root, version)
    indexed = spark.read.schema(documents.schema).parquet(path).groupBy("source").agg(
        F.count("*").alias("n"))
    rows = written(gate_rows(expected, indexed, rejected), "gate")
    outcome = gate(rows).first()
    if outcome["publish"]:
        publish(spark, f"{root}/versions", dataset, version, path, now)
    else:
        discard(spark, path)
    return rows.withColumn("published", F.lit(bool(outcome["publish"]))).withColumn("reason", F.lit(outcome["reason"]).cast("string"))


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a version's folder, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def retention_after(folders: DataFrame, published: DataFrame, keep: int = 2, pattern: str = VERSION_PATTERN) -> DataFrame:
    """Which of the found folders (dataset, version) stay: the last ``keep`` published ones of each
    dataset. Refused ones go, however new their names; foreign names are left alone."""
    order = [F.desc("published_at"), F.desc("version")]
    live = top_k_per_group(published, ["dataset"], order, keep, "_rn").select("dataset", "version", F.lit(True).alias("_keep"))
    return folders.join(live, ["dataset", "version"], "left").select(
        "dataset", "version",
        F.when(~F.col("version").rlike(pattern), "ignored").when(F.col("_keep"), "keep").otherwise("drop").alias("action"),
    )


def apply_retention(spark: SparkSession, root: str, versions_path: str, dataset: str, keep: int = 2) -> list[str]:
    """Delete the version folders under ``root`` that retention drops; returns their names. Readers resolve published versions
    only, and the last ``keep`` of those stay."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [s.getPath().getName() for s in found if s.isDirectory() and s.getPath().getName().startswith(f"{dataset}_")]
    folders = spark.createDataFrame([(dataset, n) for n in names], "dataset string, version string")
    published = spark.read.schema(VERSIONS).parquet(versions_path).filter(F.col("dataset") == dataset)
    plan = retention_after(folders, published.select("dataset", "version", "published_at"), keep)
    dropped = sorted(r["version"] for r in plan.filter("action = 'drop'").collect())  # one row per folder
    for name in dropped:
        discard(spark, f"{root}/{name}")
    return dropped


def retention_plan(versions: DataFrame, keep: int = 2, pattern: str = VERSION_PATTERN) -> DataFrame:
    """Which versions stay: the newest ``keep`` of each dataset; foreign names are left alone."""
    named = versions.filter(F.col("version").rlike(pattern))
    newest = top_k_per_group(named, ["dataset"], [F.desc("version")], keep, "_rn").select(
        "dataset", "version", F.lit(True).alias("_keep"))
    return versions.join(newest, ["dataset", "version"], "left").select(
        "dataset", "version",
        F.when(~F.col("version").rlike(pattern), "ignored")
        .when(F.col("_keep"), "keep").otherwise("drop").alias("action"),
    )


def strict_rejects(documents: DataFrame, allowed: Sequence[str], date_fields: Sequence[str]) -> DataFrame:
    """Documents ``source, doc`` (JSON) breaking a strict schema, with the reason.

    Reasons: not an object, a field outside the schema, a date that is not ISO.
    """
    from docmill.functions.dates import parse_iso_date

    v = F.try_parse_json("doc")
    known = F.array(*[F.lit(name) for name in allowed])
    read = documents.withColumn("_v", v).withColumn(
        "_fields", F.map_keys(F.try_variant_get("_v", "$", "map<string,variant>")))
    extra = F.array_sort(F.array_except("_fields", known))
    reason = F.when(F.col("_fields").isNull(), "not an object").when(
        F.size(extra) > 0, F.concat(F.lit("unknown field "), F.get(extra, F.lit(0))))
    for name in date_fields:
        text = F.try_variant_get("_v", f"$.{name}", "string")
        reason = reason.when(text.isNotNull() & parse_iso_date(text).isNull(), f"invalid date {name}")
    return read.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_v", "_fields")


def count_coverage(documents: DataFrame) -> DataFrame:
    """Counts per source against the total: rows without source show as a gap, and one row tells
    whether the groups cover everything."""
    counts = documents.rollup("source").agg(
        F.count("*").alias("n"), F.grouping("source").alias("is_total"))
    return counts.agg(
        F.max(F.when(F.col("is_total") == 1, F.col("n"))).alias("total"),
        F.sum(F.when((F.col("is_total") == 0) & F.col("source").isNotNull(), F.col("n"))).alias("covered"),
    ).withColumn("complete", F.col("total") == F.col("covered"))


def index_stats_rows(run_id: int, version: str, gate: DataFrame, published: Column, now: Column,
                     counted: bool = True) -> DataFrame:
    """History row per source of one rebuild; the indexed count is NULL when it was not taken."""
    indexed = F.col("indexed") if counted else F.lit(None)
    return gate.select(
        F.lit(run_id).cast("bigint").alias("run_id"), F.lit(version).alias("index_name"), "source",
        F.col("expected").cast("int").alias("silver_count"),
        indexed.cast("int").alias("indexed_count"),
        F.col("rejected").cast("int").alias("rejected_count"),
        published.alias("alias_switched"), now.alias("created_at"),
    )
