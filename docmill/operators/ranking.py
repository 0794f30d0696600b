"""Top-k, latest rows, pages and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_WINDOW = 10_000
MAX_PAGE = 50


def top_k_per_group(df: DataFrame, by: list[str], order: list[Column], k: int, alias: str = "rank") -> DataFrame:
    """First k rows per group. The rank filter lets Spark cut each task's groups to k rows
    before the shuffle, so a hot group never meets in one task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(alias, F.row_number().over(w)).filter(F.col(alias) <= k)


def latest_row(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return top_k_per_group(df, by, order, 1, "_rn").drop("_rn")


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """Reproducible sample: the n smallest MD5 values of the key."""
    return df.orderBy(F.md5(key), key).limit(n)


def page_end(number: int, size: int) -> int:
    """Last rank of a page; pages past MAX_WINDOW ranks or over MAX_PAGE rows are refused."""
    if number < 1 or not 1 <= size <= MAX_PAGE or number * size > MAX_WINDOW:
        raise ValueError("page outside the result window")
    return number * size


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """One page of an ordered result; past the end it is empty."""
    first = page_end(number, size) - size
    return df.orderBy(*order).limit(first + size).offset(first)


def page_per_group(ranked: DataFrame, number: int, size: int, rank: str = "rank") -> DataFrame:
    """The same page of every query of a table ranked down to page_end(number, size) at least."""
    first = page_end(number, size) - size
    return ranked.filter(F.col(rank).between(first + 1, first + size))


def report_order(status: str = "status", severity: str = "severity") -> list[Column]:
    """Failures first, errors before warnings, then check and source (NULL as empty)."""
    from docmill.model import SEVERITIES, STATUS_ORDER

    return [
        F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col(status)),
        F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col(severity)),
        F.col("check_name"),
        F.coalesce(F.col("source"), F.lit("")),
    ]
