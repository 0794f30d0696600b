"""Physical layout helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deal_out(df: DataFrame, tasks: int | None) -> DataFrame:
    """Rows dealt out over so many tasks before a heavy narrow step; None leaves them where the scan
    puts them. A table of many splits needs none; one file of one row group does."""
    return df if tasks is None else df.repartition(tasks)


def explode_once(df: DataFrame, keep: list[str], items: Column, alias: str) -> DataFrame:
    """One row per array item, the array being computed once.

    A plain explode lets the optimizer derive a filter on the size of the array and push it down
    to the scan, where a costly array expression would be computed a second time.
    """
    return df.select(*keep, F.explode_outer(items).alias(alias)).filter(F.col(alias).isNotNull())
