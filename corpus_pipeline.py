"""Corpus preparation: stages over `documents`, each written as Parquet and read again as the next one's input.

1. quality classifier: documents it rejects go
2. SimHash near-dedup: one whole document of each group of linked ones stays, the one with the smallest id
3. benchmark decontamination: documents that hold any window of a benchmark item go
4. secret scans: every secret found is replaced in the text, n_chars follows; no document goes
5. packing: what is left becomes pieces of packed sequences
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmill.llm import decontaminate, packing, quality_fm, secrets, simhash
from docmill.llm.frames import table
from docmill.session import remove_written, work_dir, written_so_far


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled documents of the whole table, does not reject."""
    model = quality_fm.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model).where("quality_kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality), ("simhash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan), ("packing", packed),
]
#: A trained classifier, XXH64 fingerprints and a tokenizer are not SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = table(spark, sf_dir, "documents"), written_so_far()
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        remove_written(spark, mark, keep=[path])  # the stage's input and what it wrote on the way
    return docs
