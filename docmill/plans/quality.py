"""Data-quality checks: expectations, evaluation, isolation, suite and history.

A check yields ``(source, value)``, one row per source. Expectations are a table
``check_name, dimension, severity, source, op, bound`` whose source may be ``default``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions.dates import number_year
from docmill.functions.text import is_sql_blank
from docmill.model import EXPECTATIONS
from docmill.operators import aggregates, keys
from docmill.session import work_dir

DEFAULT = "default"
VALUE = "decimal(38,10)"
OPERATORS = ("==", "<=", ">=", "<", ">")


@dataclass(frozen=True)
class Check:
    """One check: SQL over named tables, and (operator, bound) per source or ``default``."""

    name: str
    dimension: str
    severity: str
    sql: str
    expect: Mapping[str, tuple[str, object]] = field(default_factory=dict)


def expectations(spark: SparkSession, checks: Iterable[Check]) -> DataFrame:
    rows = [
        (c.name, c.dimension, c.severity, source, op, str(bound))
        for c in checks for source, (op, bound) in c.expect.items()
    ]
    return spark.createDataFrame(rows, EXPECTATIONS)


def holds(value: Column, op: Column, bound: Column) -> Column:
    """Exact decimal comparison by operator name; an unknown operator gives NULL."""
    value, bound = value.cast(VALUE), bound.cast(VALUE)
    return (
        F.when(op == "==", value == bound).when(op == "<=", value <= bound)
        .when(op == ">=", value >= bound).when(op == "<", value < bound)
        .when(op == ">", value > bound)
    )


def row_problems(values: DataFrame, run: list[str]) -> DataFrame:
    """First reason why a check's rows are refused: bad source, missing value, repeated source."""
    source_blank = F.col("source").isNull() | ~F.col("source").rlike(r"(?U)\S")
    per_source = values.groupBy(*run, "check_name", "source").agg(
        F.count("*").alias("_n"), F.count_if(F.col("value").isNull()).alias("_nulls"))
    reasons = per_source.groupBy(*run, "check_name").agg(
        F.count_if(source_blank).alias("_blank"),
        F.min(F.when(F.col("_nulls") > 0, F.col("source"))).alias("_null_source"),
        F.min(F.when(F.col("_n") > 1, F.col("source"))).alias("_twice"),
    )
    error = (
        F.when(F.col("_blank") > 0, "blank source name")
        .when(F.col("_null_source").isNotNull(),
              F.concat(F.lit("no value for source "), "_null_source"))
        .when(F.col("_twice").isNotNull(),
              F.concat(F.lit("several rows for source "), "_twice"))
    )
    return reasons.select(*run, "check_name", error.alias("error")).filter(F.col("error").isNotNull())


def evaluate(values: DataFrame, expected: DataFrame, run: list[str] | None = None,
             runs: DataFrame | None = None, failures: DataFrame | None = None,
             catalogue: DataFrame | None = None) -> DataFrame:
    """Results of checks: pass, fail, unchecked, no_data, query_error.

    ``values`` holds ``check_name, source, value`` and the columns of ``run`` when several runs
    are judged together (``runs`` then lists them). ``failures(check_name, error)`` are checks
    that could not be computed at all; ``catalogue(check_name, dimension, severity)`` is needed
    only for checks without any expectation.
    """
    run = run or []
    checks = catalogue if catalogue is not None else expected.select(
        "check_name", "dimension", "severity").distinct()
    problems = row_problems(values, run)
    if failures is not None:
        problems = problems.unionByName(failures)
    own = expected.filter(F.col("source") != DEFAULT).select(
        "check_name", "source", F.col("op").alias("_op"), F.col("bound").alias("_bound"))
    fallback = expected.filter(F.col("source") == DEFAULT).select(
        "check_name", F.col("op").alias("_dop"), F.col("bound").alias("_dbound"))
    sound = values.join(problems.select(*run, "check_name"), [*run, "check_name"], "left_anti")
    judged = (
        sound.join(own, ["check_name", "source"], "left").join(fallback, "check_name", "left")
        .withColumn("_o", F.coalesce("_op", "_dop"))
        .withColumn("_b", F.when(F.col("_op").isNotNull(), F.col("_bound")).otherwise(F.col("_dbound")))
        .select(
            *run, "check_name", "source", F.col("value").cast(VALUE).alias("value"),
            F.concat_ws(" ", "_o", "_b").alias("_text"),
            F.when(F.col("_o").isNull(), "unchecked")
            .when(holds(F.col("value"), F.col("_o"), F.col("_b")), "pass")
            .otherwise("fail").alias("status"),
        )
    )
    universe = own if runs is None else _repeat(own, runs)
    absent = (
        universe.join(problems.select(*run, "check_name"), [*run, "check_name"], "left_anti")
        .join(sound.select(*run, "check_name", "source"), [*run, "check_name", "source"], "left_anti")
        .select(
            *run, "check_name", "source", F.lit(None).cast(VALUE).alias("value"),
            F.concat_ws(" ", "_op", "_bound").alias("_text"), F.lit("no_data").alias("status"))
    )
    broken = problems.select(
        *run, "check_name", F.lit(None).cast("string").alias("source"),
        F.lit(None).cast(VALUE).alias("value"), F.lit("").alias("_text"),
        F.lit("query_error").alias("status"), "error")
    results = (
        judged.unionByName(absent).withColumn("error", F.lit(None).cast("string")).unionByName(broken)
    )
    return results.join(checks, "check_name", "left").select(
        *run, "check_name", "dimension", "source", "value",
        F.nullif("_text", F.lit("")).alias("expected"), "severity", "status", "error",
    )


def _repeat(own: DataFrame, runs: DataFrame) -> DataFrame:
    """Declared (check, source) pairs for every run: the catalogue is one array (a scalar
    subquery) expanded next to each run, so no join is needed."""
    pairs = own.agg(F.collect_list(F.struct(*own.columns)).alias("_pairs")).scalar()
    return runs.select(*runs.columns, pairs.alias("_pairs")).select(
        *runs.columns, F.inline("_pairs"))


def run_checks(spark: SparkSession, checks: list[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every check on its own: one that fails gives a query_error row, the others still run.

    Analysis errors surface at once, run-time errors when the few rows of the check are
    written, so both end inside the same guard and nothing passes through the driver.
    """
    folder = work_dir(spark, "checks")
    written, failed = [], []
    for check in checks:
        try:
            result = spark.sql(check.sql, **tables)
            problem = shape_problem(result)
            if problem:
                raise ValueError(problem)
            path = f"{folder}/{check.name}"
            result.select(
                F.lit(check.name).alias("check_name"), "source", F.col("value").cast(VALUE).alias("value")
            ).write.parquet(path)
            written.append(path)
        except Exception as error:  # noqa: BLE001 - any failure of user SQL is a result here
            lines = str(error).strip().splitlines()
            failed.append((check.name, lines[0] if lines else type(error).__name__))
    schema = f"check_name STRING, source STRING, value {VALUE}"
    values = spark.read.schema(schema).parquet(*written) if written else spark.createDataFrame([], schema)
    failures = spark.createDataFrame(failed, "check_name STRING, error STRING")
    catalogue = spark.createDataFrame(
        [(c.name, c.dimension, c.severity) for c in checks], "check_name STRING, dimension STRING, severity STRING")
    return evaluate(values, expectations(spark, checks), failures=failures, catalogue=catalogue)


def shape_problem(result: DataFrame) -> str | None:
    """Why a result is not (source, value) with a text source and a numeric value."""
    if result.columns != ["source", "value"]:
        return f"a check gives source and value; this one gives {', '.join(result.columns)}"
    types = dict(result.dtypes)
    if types["source"] not in ("string", "void"):
        return f"its source is of type {types['source']}, not text"
    numeric = types["value"].startswith("decimal") or types["value"] in (
        "tinyint", "smallint", "int", "bigint", "float", "double", "void")
    return None if numeric else f"its value is of type {types['value']}, not a number"


# The thirteen checks of the catalogue, as DataFrame plans. Sources are parameters.

def rows_missing_downstream(raw: DataFrame, silver: DataFrame, sources: list[str] | None = None) -> DataFrame:
    kept = raw if not sources else raw.filter(F.col("source").isin(*sources))
    return keys.count_unmatched(kept, silver, ["source", "external_id"], "source")


def missing_date(silver: DataFrame) -> DataFrame:
    return aggregates.count_where(silver, F.col("decision_date").isNull())


def missing_type_pct(silver: DataFrame) -> DataFrame:
    return aggregates.percent_where(silver, F.col("decision_type").isNull())


def _empty_text(exempt: str, today: Column, days: int = 90) -> Column:
    recent = (F.col("source") == exempt) & (F.col("decision_date") > F.date_sub(today, days))
    return is_sql_blank(F.col("text")) & ~recent


def empty_text(silver: DataFrame, exempt: str, today: Column) -> DataFrame:
    """A NULL date makes the exemption NULL, so such a row is not counted (three-valued logic)."""
    return aggregates.count_where(silver, _empty_text(exempt, today))


def index_completeness(silver: DataFrame, index_stats: DataFrame) -> DataFrame:
    """Stored rows minus indexed rows of the last published version; may be negative."""
    published = index_stats.filter("alias_switched")
    last = published.agg(F.max("run_id").alias("run_id"))
    indexed = index_stats.join(last, "run_id", "left_semi").select(
        "source", F.col("indexed_count").alias("n"))
    stored = silver.groupBy("source").agg(F.count("*").alias("n"))
    return keys.count_difference(stored, indexed)


def _impossible(founded_source: str, founded: str, today: Column) -> Column:
    d = F.col("decision_date")
    return (d > today) | ((F.col("source") == founded_source) & (d < F.lit(founded).cast("date")))


def impossible_date(silver: DataFrame, founded_source: str, founded: str, today: Column) -> DataFrame:
    return aggregates.count_where(silver, _impossible(founded_source, founded, today))


def findability_number(eval_runs: DataFrame) -> DataFrame:
    """Latest hit@10 by number; no row at all when never evaluated."""
    return (
        eval_runs.filter(F.col("mode") == "number").orderBy(F.desc("run_id")).limit(1)
        .select(F.lit("search").alias("source"), F.col("hit_at_10").alias("value"))
    )


def findability_title(eval_runs: DataFrame, results: DataFrame, boost: float = 2) -> DataFrame:
    """Share of unambiguous titles at rank 1 in the latest evaluation; NULL when there is none."""
    last = eval_runs.filter((F.col("mode") == "title") & (F.col("title_boost") == boost)).agg(
        F.max("eval_id").alias("eval_id"))
    return (
        results.join(last, "eval_id", "left_semi").filter(~F.col("ambiguous_title"))
        .agg(F.round(F.avg(F.when(F.col("rank") == 1, 1.0).otherwise(0.0)), 4).alias("value"))
        .select(F.lit("search").alias("source"), "value")
    )


def duplicate_number(silver: DataFrame, source: str) -> DataFrame:
    return aggregates.duplicate_groups(
        silver.filter(F.col("source") == source), F.col("decision_number"), source)


def duplicate_json_key(silver: DataFrame, source: str, path: str) -> DataFrame:
    return aggregates.duplicate_groups(
        silver.filter(F.col("source") == source), F.get_json_object("attributes", path), source)


def number_year_mismatch(silver: DataFrame, source: str) -> DataFrame:
    gap = F.year("decision_date") - number_year(F.col("decision_number"))
    kept = silver.filter((F.col("source") == source) & F.col("decision_number").rlike(r"\A\d{2}-"))
    return kept.agg(F.count_if(~gap.isin(0, 1)).alias("value")).select(
        F.lit(source).alias("source"), "value")


def hours_since_success(runs: DataFrame, now: Column, sources: list[str] | None = None) -> DataFrame:
    done = runs.filter(F.col("status") == "success")
    if sources:
        done = done.filter(F.col("source").isin(*sources))
    return aggregates.hours_since(done, "finished_at", now)


def missing_from_dataset(listed: DataFrame, dataset: DataFrame, listed_key: Column, dataset_key: Column,
                         source: str) -> DataFrame:
    return keys.missing_rows(listed, dataset, listed_key, dataset_key).agg(
        F.count("*").alias("value")).select(F.lit(source).alias("source"), "value")


def silver_counts_one_pass(silver: DataFrame, exempt: str, founded: str, today: Column) -> DataFrame:
    """Four per-source checks out of one scan and one aggregate, in long form."""
    share = F.lit(100).cast("decimal(5,1)") * F.count_if(F.col("decision_type").isNull()) / F.count("*")
    wide = silver.groupBy("source").agg(
        F.count_if(F.col("decision_date").isNull()).cast(VALUE).alias("missing_decision_date"),
        F.round(share, 2).cast(VALUE).alias("missing_decision_type_pct"),
        F.count_if(_empty_text(exempt, today)).cast(VALUE).alias("empty_text"),
        F.count_if(_impossible(exempt, founded, today)).cast(VALUE).alias("impossible_decision_date"),
    )
    names = [c for c in wide.columns if c != "source"]
    return wide.unpivot(["source"], names, "check_name", "value").select("check_name", "source", "value")


def suite_values(parts: Mapping[str, DataFrame]) -> DataFrame:
    """All checks as one plan: ``check_name, source, value``."""
    typed = [
        df.select(F.lit(name).alias("check_name"), "source", F.col("value").cast(VALUE).alias("value"))
        for name, df in parts.items()
    ]
    return reduce(DataFrame.unionByName, typed)


def append_history(results: DataFrame, run_id: int, checked_at: Column, path: str) -> None:
    """One commit per run; the outcome of the run does not depend on the verdict."""
    stamped = results.select(
        F.lit(run_id).cast("bigint").alias("run_id"), *results.columns, checked_at.alias("checked_at"))
    stamped.write.mode("append").parquet(path)
