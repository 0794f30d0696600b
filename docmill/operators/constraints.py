"""Constraint checks of the shape (source, value): violations counted per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def primary_key(df: DataFrame, keys: list[str], by: str = "source") -> DataFrame:
    """Keys held by more than one row, or holding NULL."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    broken = F.col("_n") > 1
    for key in keys:
        broken = broken | F.col(key).isNull()
    return groups.groupBy(by).agg(F.count_if(broken).alias("value"))


def foreign_key(df: DataFrame, column: str, target: DataFrame, target_column: str,
                by: str = "source") -> DataFrame:
    """Rows whose reference is not NULL and has no target."""
    known = target.select(F.col(target_column).alias(column)).distinct().withColumn("_k", F.lit(True))
    return (
        df.select(by, column).join(known, column, "left").groupBy(by)
        .agg(F.count_if(F.col(column).isNotNull() & F.col("_k").isNull()).alias("value"))
    )


def not_null(df: DataFrame, columns: list[str], by: str = "source") -> DataFrame:
    """NULL cells per column, in long form."""
    counts = df.groupBy(by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([by], columns, "column_name", "value")


def row_checks(df: DataFrame, rules: dict[str, Column], by: str = "source") -> DataFrame:
    """Rows breaking each rule (a NULL rule result does not break it), in long form."""
    broken = df.groupBy(by).agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return broken.unpivot([by], list(rules), "rule", "value")


def unique_nulls_equal(df: DataFrame, keys: list[str], by: str = "source") -> DataFrame:
    """Key combinations used more than once, NULLs being equal (as grouping has it)."""
    return (
        df.groupBy(by, *keys).agg(F.count("*").alias("_n")).groupBy(by)
        .agg(F.count_if(F.col("_n") > 1).alias("value"))
    )
