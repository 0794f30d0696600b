"""Run log and incremental windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_DAYS = 7
DEFAULT_LOOKBACK = 14


def collapse(events: DataFrame) -> DataFrame:
    """One row per run out of append-only start and finish events.

    ``events``: run_id, event (start/finish), at, source, date_type, date_start, date_end, status,
    nb_fetched, nb_new, nb_changed, error. Start fields come from the start event, outcome fields
    from the last finish event; an unfinished run is ``running``.
    """
    start, finish = F.col("event") == "start", F.col("event") == "finish"
    opened = F.struct("at", "source", "date_type", "date_start", "date_end")
    closed = F.struct("at", "status", "nb_fetched", "nb_new", "nb_changed", "error")
    runs = events.groupBy("run_id").agg(
        F.min(F.when(start, opened)).alias("s"),
        F.max(F.when(finish, closed)).alias("f"),
    )
    return runs.select(
        "run_id", "s.source", "s.date_type", "s.date_start", "s.date_end",
        F.col("s.at").alias("started_at"), F.col("f.at").alias("finished_at"),
        F.coalesce("f.status", F.lit("running")).alias("status"),
        *[F.coalesce(f"f.{c}", F.lit(0)).alias(c) for c in ("nb_fetched", "nb_new", "nb_changed")],
        F.col("f.error").alias("error"),
    )


def last_successful_end(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Latest end of a successful run per source and date type; a NULL date type never matches."""
    by = by or ["source", "date_type"]
    return (
        runs.filter((F.col("status") == "success") & F.col("date_type").isNotNull())
        .groupBy(*by).agg(F.max("date_end").alias("last_end"))
    )


def window(last_end: Column, today: Column, lookback: int = DEFAULT_LOOKBACK,
           start: Column | None = None, end: Column | None = None) -> tuple[Column, Column]:
    """(start, end) to collect. An explicit start wins; without a previous run the window is the
    last week; otherwise it overlaps the previous one. A start after the end means nothing to do."""
    if lookback < 0:
        raise ValueError(f"lookback must not be negative: {lookback}")
    until = today if end is None else F.coalesce(end, today)
    resumed = F.date_sub(F.date_add(last_end, 1), lookback)
    since = F.coalesce(resumed, F.date_sub(until, DEFAULT_DAYS))
    return (since if start is None else F.coalesce(start, since)), until
