"""URL policy: which addresses a site lets be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.urls import host, path_and_query


def rule_regex(pattern: Column) -> Column:
    """Anchored regular expression of a rule pattern, where * is any text and a final $ the end."""
    body = F.regexp_replace(pattern, r"\$\z", "")
    escaped = F.regexp_replace(body, r"([.+?^$(){}|\[\]\\])", r"\\$1")
    starred = F.replace(escaped, F.lit("*"), F.lit(".*"))
    return F.concat(F.lit(r"(?s)\A"), starred, F.when(pattern.endswith("$"), F.lit(r"\z")).otherwise(F.lit("")))


def allowed_urls(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """URLs no rule of their host forbids; a host without rules allows everything.

    ``rules(host, pattern)`` joins on the host, so it is a hash join with the pattern as a
    further condition.
    """
    keyed = urls.withColumn("_host", host(F.col(url))).withColumn("_target", path_and_query(F.col(url)))
    forbidden = rules.select(F.col("host").alias("_host"), rule_regex(F.col("pattern")).alias("_regex"))
    match = (keyed["_host"] == forbidden["_host"]) & F.expr("rlike(_target, _regex)")
    return keyed.join(forbidden, match, "left_anti").drop("_host", "_target")
