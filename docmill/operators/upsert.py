"""Idempotent upsert with change detection.

A batch row is ``source, external_id, seq, payload, payload_hash``; the stored table follows
``model.RAW``. Nothing is ever deleted, ``first_seen_run`` never moves. A row without hash has a
payload that cannot be read: it is counted as quarantined and stores nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmill.session import written

KEY = ["source", "external_id"]
# A key repeated without end is cut into ranges of this many sequence numbers.
SEQ_SPAN = 100_000


def readable(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col("payload_hash").isNotNull())


def last_per_key(batch: DataFrame) -> DataFrame:
    """One row per key: the last readable payload, and the smallest and largest hash the batch brought.

    An aggregate, so a key repeated millions of times is reduced before the shuffle.
    """
    last = F.max_by(F.struct("payload", "payload_hash"), F.col("seq"))
    return readable(batch).groupBy(*KEY).agg(
        last.alias("last"),
        F.min("payload_hash").alias("low_hash"),
        F.max("payload_hash").alias("high_hash"),
    ).select(*KEY, "last.payload", "last.payload_hash", "low_hash", "high_hash")


def last_hashes(batch: DataFrame) -> DataFrame:
    """The hash alone of the last readable row per key, with its ``seq``: no payload is shuffled."""
    last = F.max(F.struct("seq", "payload_hash"))
    return readable(batch).groupBy(*KEY).agg(last.alias("last")).select(*KEY, "last.seq", "last.payload_hash")


def decisions(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """What becomes of each key of the batch, by keys and hashes alone: ``known`` (it is stored), ``differs`` (some row of the
    batch differed from the stored hash, so it was updated at least once), and the last row's ``seq`` and hash."""
    last = readable(batch).groupBy(*KEY).agg(
        F.max(F.struct("seq", "payload_hash")).alias("last"), F.min("payload_hash").alias("low"), F.max("payload_hash").alias("high"))
    old = F.col("_hash")
    differs = old.isNull() | (F.col("low") != old) | (F.col("high") != old)
    found = last.join(stored.select(*KEY, F.col("payload_hash").alias("_hash"), F.lit(True).alias("_known")), KEY, "left")
    return found.select(
        *KEY, F.col("last.seq").alias("seq"), F.col("last.payload_hash").alias("payload_hash"),
        F.coalesce("_known", F.lit(False)).alias("known"), differs.alias("differs"))


def upsert(stored: DataFrame, batch: DataFrame, run_id: int, now: Column) -> DataFrame:
    """New version of the stored table after the batch.

    First the decisions, then payloads: only those of new and changed rows are fetched from the batch. Both results are stored, so
    their size is known; while they may be broadcast by it, no payload is shuffled at all, neither of the batch nor of the table.
    """
    decided = written(decisions(stored, batch), "decisions")
    moved = decided.filter("differs").select(*KEY, "seq", "payload_hash")
    payloads = readable(batch).join(moved, [*KEY, "seq", "payload_hash"]).groupBy(*KEY).agg(F.max("payload").alias("payload"))
    changes = written(decided.join(payloads, KEY, "left"), "changes")
    new, old, run = changes.alias("new"), stored.alias("old"), F.lit(run_id).cast("bigint")
    seen, differs = F.col("new.differs").isNotNull(), F.coalesce("new.differs", F.lit(False))
    kept = old.join(new, KEY, "left").select(
        *KEY,
        *[F.when(differs, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in ("payload", "payload_hash")],
        "old.first_seen_run",
        F.when(seen, run).otherwise(F.col("old.last_seen_run")).alias("last_seen_run"),
        F.when(differs, now).otherwise(F.col("old.updated_at")).alias("updated_at"),
    )
    added = changes.filter(~F.col("known")).select(
        *KEY, "payload", "payload_hash", run.alias("first_seen_run"), run.alias("last_seen_run"), now.alias("updated_at"))
    return kept.unionByName(added)


def previous_in_key(batch: DataFrame, value: str, alias: str) -> DataFrame:
    """Add the value of the previous row of the same key in batch order.

    Keys are cut into ranges of ``seq`` so that one hot key is spread over many tasks; only the
    first row of a range looks at the last value of the range before it.
    """
    ranged = batch.withColumn("_range", F.floor(F.col("seq") / SEQ_SPAN))
    within = Window.partitionBy(*KEY, "_range").orderBy("seq")
    across = Window.partitionBy(*KEY).orderBy("_range")
    rows = ranged.withColumn("_prev", F.lag(value).over(within))
    ends = (
        ranged.groupBy(*KEY, "_range")
        .agg(F.max_by(value, "seq").alias("_end"))
        .withColumn("_before", F.lag("_end").over(across))
        .filter(F.col("_before").isNotNull())
        .select(*KEY, "_range", "_before")
    )
    return (
        rows.join(ends, [*KEY, "_range"], "left")
        .withColumn(alias, F.coalesce("_prev", "_before"))
        .drop("_range", "_prev", "_before")
    )


def sequential_status(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """new / changed / unchanged for every batch row, each against the state just before it;
    quarantined for unreadable rows, which leave that state as it is."""
    refused = batch.filter(F.col("payload_hash").isNull()).withColumn("status", F.lit("quarantined"))
    hashes = stored.select(*KEY, F.col("payload_hash").alias("_stored"))
    before = F.coalesce(F.col("_previous"), F.col("_stored"))
    return (
        previous_in_key(readable(batch), "payload_hash", "_previous")
        .join(hashes, KEY, "left")
        .withColumn(
            "status",
            F.when(before.isNull(), "new")
            .when(before != F.col("payload_hash"), "changed")
            .otherwise("unchanged"),
        )
        .drop("_previous", "_stored")
        .unionByName(refused)
    )


def ingest_counts(statuses: DataFrame, by: list[str]) -> DataFrame:
    """fetched / new / changed / unchanged / quarantined / missing_id; rows without id have no status."""
    return statuses.groupBy(*by).agg(
        F.count("*").alias("fetched"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("new", "changed", "unchanged", "quarantined")],
        F.count_if(F.col("status").isNull()).alias("missing_id"),
    )
