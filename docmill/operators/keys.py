"""Joins and counts on keys: missing rows, shared keys, fallbacks, merges of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_unmatched(left: DataFrame, right: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Rows of ``left`` without a partner, per group; groups without any count 0."""
    found = right.select(*keys).distinct().withColumn("_found", F.lit(True))
    return (
        left.join(found, keys, "left")
        .groupBy(by)
        .agg(F.count_if(F.col("_found").isNull()).alias("value"))
    )


def missing_rows(listed: DataFrame, known: DataFrame, listed_key: Column, known_key: Column) -> DataFrame:
    """Listed rows whose normalised key is not known; a NULL key is never known."""
    keys = known.select(known_key.alias("_key")).filter(F.col("_key").isNotNull())
    return listed.withColumn("_key", listed_key).join(keys, "_key", "left_anti").drop("_key")


def shared_keys(df: DataFrame, key: Column) -> DataFrame:
    """Keys carried by more than one row, with their counts; NULL keys do not count."""
    return (
        df.select(key.alias("key")).filter(F.col("key").isNotNull())
        .groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    )


def flag_shared(df: DataFrame, key: Column, alias: str, universe: DataFrame | None = None,
                universe_key: Column | None = None) -> DataFrame:
    """Flag rows whose key is shared within the universe (the table itself by default).

    Counted with a partial aggregate and joined back: no window gathers a hot key in one task.
    Keys may be long texts, so their digests travel instead. Rows without a key are dealt out by all
    their values (behind a mark that no digest has), however many they are.
    """
    universe, counted = (df, key) if universe is None else (universe, key if universe_key is None else universe_key)
    shared = shared_keys(universe, F.sha2(counted, 256)).select("key", F.lit(True).alias("_shared"))
    return (
        df.withColumn("key", F.coalesce(F.sha2(key, 256), F.concat(F.lit("-"), F.xxhash64(*df.columns)))).join(shared, "key", "left")
        .withColumn(alias, F.coalesce("_shared", F.lit(False)))
        .drop("key", "_shared")
    )


def with_shared_number(df: DataFrame, key: Column) -> DataFrame:
    """Rows whose key is shared (IN over a grouped subquery)."""
    return df.withColumn("key", key).join(shared_keys(df, key), "key", "left_semi").drop("key")


def count_difference(left: DataFrame, right: DataFrame, by: str = "source") -> DataFrame:
    """left.n - right.n for the union of groups, a missing side counting 0."""
    return (
        left.withColumnRenamed("n", "_l").join(right.withColumnRenamed("n", "_r"), by, "full_outer")
        .select(by, (F.coalesce("_l", F.lit(0)) - F.coalesce("_r", F.lit(0))).alias("value"))
    )


def merge_counts(parts: dict[str, DataFrame], by: str = "source", counted: bool = True,
                 optional: str | None = None) -> DataFrame:
    """One row per group found in any part; missing counts are 0.

    ``optional`` names the part that stays NULL everywhere when it was not counted at all.
    """
    tables = [df.select(by, F.col("n").alias(name)) for name, df in parts.items()]
    merged = reduce(lambda a, b: a.join(b, by, "full_outer"), tables)
    columns = []
    for name in parts:
        value = F.coalesce(F.col(name), F.lit(0)).cast("bigint")
        if name == optional and not counted:
            value = F.lit(None).cast("bigint")
        columns.append(value.alias(name))
    return merged.select(by, *columns)
