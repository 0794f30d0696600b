"""Helpers shared by the operators: schemas, crc32 folds, the labelled sample."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows a classifier is fitted on at most; scoring and every count still cover all rows.
SAMPLE_ROWS = 2000


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id's text modulo n; null ids are in no fold."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_fields(df: DataFrame, added: dict[str, str]) -> T.StructType:
    """The schema of df and more columns."""
    fields = T.StructType(list(df.schema))
    for name, kind in added.items():
        fields = fields.add(name, kind)
    return fields


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct `row`: whatever their names, they meet no other column."""
    return F.struct(*(df[c] for c in df.columns)).alias("row")


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of so few rows, Arrow's and the Parquet reader's, for the jobs run inside; for tables whose rows are megabytes."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        for key in keys:
            spark.conf.set(key, before[key])


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, folds: int = 0, held: int = 0, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Texts of at most `rows` labelled documents, chosen by a hash of the id; `label` is 0 or 1.

    Rows whose fold is `held` are left out. A document with several labels keeps its smallest one, and an id with several
    rows its smallest text, found by partial minima. Ids are bounded by `rows`, so they may be broadcast; no other document
    is moved.
    """
    known = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
    if folds:
        known = known.where(fold("doc_id", folds) != held)
    chosen = (
        known.groupBy("doc_id").agg(F.min(column).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    columns = [c for c in ("text", "n_chars") if c in docs.columns]
    found = docs.select("doc_id", *columns).join(F.broadcast(chosen), "doc_id")
    least = found.groupBy("doc_id", "label").agg(F.min(F.struct(*columns)).alias("row"))
    return least.select("doc_id", "label", "row.*")
