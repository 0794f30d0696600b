"""One ingestion run: landed pages to a new version of the stored layer, with counters and the run's row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.variants import last_key_wins
from docmill.model import RUNS
from docmill.operators import upsert
from docmill.plans import publish
from docmill.session import remove_written, work_dir, written, written_so_far
from docmill.sources import landed


def batch_of_pages(pages: DataFrame, id_field: str) -> DataFrame:
    """Upsert batch of landed pages, records without identifier included (their id is NULL)."""
    return landed.to_batch(landed.page_records(pages), F.col("scan"), id_field)


def ingest(batch: DataFrame, stored: DataFrame, run_id: int, started_at: Column, now: Column, root: str,
           dataset: str, version: str) -> tuple[DataFrame, DataFrame]:
    """Store a batch and publish the layer's new version; returns (counters per source, run rows).

    Records without identifier and unreadable payloads are counted and stored nowhere. The version
    is written once and read by key from then on; a failing write leaves the published one as it is.
    """
    spark, mark = batch.sparkSession, written_so_far()
    last_key_wins(spark)
    batch = written(batch, "batch")
    kept, missing = landed.split_missing_id(batch)
    statuses = upsert.sequential_status(stored, kept).select("source", "status").unionByName(
        missing.select("source", F.lit(None).cast("string").alias("status")))
    counted = work_dir(spark, "counters")
    upsert.ingest_counts(statuses, ["source"]).write.parquet(counted)
    counters = spark.read.parquet(counted)
    path = publish.write_version(upsert.upsert(stored, kept, run_id, now), root, version)
    publish.publish(spark, f"{root}/versions", dataset, version, path, now)
    rows = counters.select(
        F.lit(run_id).cast("bigint").alias("run_id"), "source", F.lit(None).cast("string").alias("date_type"),
        F.lit(None).cast("date").alias("date_start"), F.lit(None).cast("date").alias("date_end"),
        started_at.alias("started_at"), now.alias("finished_at"), F.lit("success").alias("status"),
        F.col("fetched").cast("int").alias("nb_fetched"), F.col("new").cast("int").alias("nb_new"),
        F.col("changed").cast("int").alias("nb_changed"), F.lit(None).cast("string").alias("error"))
    rows.write.mode("append").parquet(f"{root}/runs")
    remove_written(spark, mark, keep=[root, counted])
    return counters, spark.read.schema(RUNS).parquet(f"{root}/runs").filter(F.col("run_id") == run_id)
