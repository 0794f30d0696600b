"""Aggregations shared by checks, evaluation and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.dates import elapsed_hours
from docmill.model import BLOCKING, STATUS_ORDER


def count_where(df: DataFrame, condition: Column, by: str = "source") -> DataFrame:
    """Conditional count per group; a NULL condition does not count."""
    return df.groupBy(by).agg(F.count_if(condition).alias("value"))


def percent_where(df: DataFrame, condition: Column, by: str = "source") -> DataFrame:
    share = F.lit(100).cast("decimal(5,1)") * F.count_if(condition) / F.count("*")
    return df.groupBy(by).agg(F.round(share, 2).cast("decimal(38,10)").alias("value"))


def duplicate_groups(df: DataFrame, key: Column, source: str) -> DataFrame:
    """Number of keys used more than once: always one row, 0 when there are none."""
    groups = (
        df.select(key.alias("k")).filter(F.col("k").isNotNull())
        .groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    )
    return groups.agg(F.count("*").alias("value")).select(F.lit(source).alias("source"), "value")


def hours_since(df: DataFrame, moment: str, now: Column, by: str = "source", digits: int = 0) -> DataFrame:
    age = elapsed_hours(now, F.max(moment))
    return df.groupBy(by).agg(F.round(age, digits).alias("value"))


def hours_since_wide(df: DataFrame, moment: str, now: Column, groups: list[str], digits: int = 1) -> DataFrame:
    """One row, one column per listed group, NULL for a group never seen."""
    return df.agg(*[
        F.round(elapsed_hours(now, F.max(F.when(F.col("source") == g, F.col(moment)))), digits).alias(g)
        for g in groups
    ])


def true_share(condition: Column) -> Column:
    """Share of rows where the condition holds, NULL counting as false."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))


def metric_columns(rank: Column) -> list[Column]:
    """sample size, hit@1, hit@10, MRR; ranks outside the list are NULL and weigh 0."""
    return [
        F.count("*").alias("sample_size"),
        true_share(rank == 1).alias("hit_at_1"),
        true_share(rank.isNotNull()).alias("hit_at_10"),
        F.avg(F.coalesce(F.lit(1.0) / rank, F.lit(0.0))).alias("mrr"),
    ]


def group_metrics(results: DataFrame, flags: list[str], by: list[str]) -> DataFrame:
    """Metrics per flag and value; combinations without rows stay, with sample size 0."""
    counted = (
        results.select(
            *by, "rank",
            F.explode(F.array(*[
                F.struct(F.lit(f).alias("group"), F.col(f).alias("value")) for f in flags
            ])).alias("g"),
        )
        .groupBy(*by, "g.group", "g.value").agg(*metric_columns(F.col("rank")))
    )
    # The grid is one row per evaluation times (flags x 2): expanded by explode, not crossed.
    grid = results.select(*by).distinct().select(
        *by, F.explode(F.array(*[F.lit(f) for f in flags])).alias("group")
    ).select(*by, "group", F.explode(F.array(F.lit(True), F.lit(False))).alias("value"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, "group", "value"]]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return grid.alias("a").join(counted.alias("b"), condition, "left").select(
        *[F.col(f"a.{c}") for c in [*by, "group", "value"]],
        F.coalesce("b.sample_size", F.lit(0)).alias("sample_size"),
        "b.hit_at_1", "b.hit_at_10", "b.mrr",
    )


def status_counts(results: DataFrame, by: list[str]) -> DataFrame:
    """One column per status, zero-filled."""
    return results.groupBy(*by).agg(
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATUS_ORDER]
    )


def is_blocking() -> Column:
    return (F.col("severity") == "error") & F.col("status").isin(*BLOCKING)


def verdict(results: DataFrame, by: list[str]) -> DataFrame:
    blocked = F.coalesce(F.bool_or(is_blocking()), F.lit(False))
    return results.groupBy(*by).agg(
        F.when(blocked, "failure").otherwise("success").alias("verdict"),
        F.count_if(is_blocking()).alias("n_blocking"),
    )
