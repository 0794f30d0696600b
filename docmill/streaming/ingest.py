"""Continuous ingestion of landed records, with the same outcome as the batch upsert.

What comes out is an append-only change log, one folder per micro-batch: a new or changed record adds
its payload, an unchanged one only the fact that it was seen. A micro-batch thus writes in proportion
to itself, and a replayed one overwrites its own folder only.

``start_keyed_upsert`` keeps the last hash of every key in Spark's state store (RocksDB on the
executors' disks, changes in the checkpoint), by blocks of keys: a micro-batch looks up the blocks of
the keys it brings and reads nothing else, whatever was stored before. For small batches against a
large table; a block costs a Python call. ``start_upsert`` decides from the log alone, by a join: in it one folder per bucket of
keys, a snapshot of their hashes every COMPACT batches. For large batches, such as a first load.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from docmill.operators.upsert import KEY, last_per_key, readable
from docmill.session import written

LOG = (
    "source STRING, external_id STRING, payload STRING, payload_hash STRING, run_id BIGINT, "
    "status STRING"
)
BUCKETS, COMPACT = 16, 16


def read_pages(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    """Landed page files as a stream, schema given."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)
    )


def read_table_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream to a table until all available input is read; a restart goes on where the
    checkpoint stands and writes nothing twice."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def drop_rereads(records: DataFrame, key: list[str]) -> DataFrame:
    """Drop versions that were read before, in this micro-batch or any earlier one.

    There is no watermark, so a late record is never dropped; a micro-batch costs in proportion to
    itself, and the keys seen are kept as state, in memory unless the session names another
    provider; ``append_once`` needs none. A pre-filter only: content that changes and then reverts loses its
    last version here, so the upsert below is authoritative and does not need this step.
    """
    return records.dropDuplicates(key)


def append_once(stream: DataFrame, key: list[str], moment: str, path: str, checkpoint: str) -> None:
    """Append the versions (``key``) that were not stored before, in this micro-batch or any earlier one, however late they come.

    What is stored is itself the memory: a micro-batch reads the keys of the days it touches (``moment`` belongs to the version, so
    all its reads fall on one day), so nothing is held in executors' memory, and what it costs does not grow with what other days
    hold. A replayed micro-batch overwrites its own folder.
    """
    spark = stream.sparkSession
    stored = T.StructType(list(stream.schema)).add("batch_id", T.LongType()).add("day", T.DateType())
    spark.createDataFrame([], stored).drop("batch_id").write.mode("ignore").parquet(f"{path}/batch_id=-1/day=1970-01-01")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = written(batch.dropDuplicates(key).withColumn("day", F.to_date(moment)), "versions")
        days = [r["day"] for r in rows.select("day").distinct().collect()]  # of one micro-batch
        touched = F.col("day").isin([d for d in days if d is not None])
        if None in days:
            touched = touched | F.col("day").isNull()
        known = spark.read.schema(stored).parquet(path).filter((F.col("batch_id") < batch_id) & touched).select(*key)
        same = [rows[k].eqNullSafe(known[k]) for k in key]
        fresh = rows.join(known, reduce(lambda a, b: a & b, same), "left_anti")
        fresh.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch_id={batch_id}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def bucket() -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).cast("int")


def _hashes(rows: DataFrame) -> DataFrame:
    """Last hash per key, with the micro-batch that brought it; reads no payload."""
    return rows.filter(F.col("payload_hash").isNotNull()).groupBy("bucket", *KEY).agg(
        F.max_by("payload_hash", "batch_id").alias("payload_hash"), F.max("batch_id").alias("batch_id"))


def stored_hashes(spark: SparkSession, log_path: str, batch_id: int, touched: list[int] | None = None) -> DataFrame:
    """Hash per key before a micro-batch, of the touched buckets (all by default).

    Folder names are partition columns: other buckets, later and half written folders are pruned.
    Snapshots stand at fixed micro-batches, so none has to be looked for.
    """
    columns = ["bucket", *KEY, "payload_hash", "batch_id"]
    base = (batch_id - 1) // COMPACT * COMPACT - 1
    log = spark.read.schema(f"{LOG}, batch_id BIGINT, bucket INT").parquet(log_path).select(*columns)
    rows = log.filter((F.col("batch_id") > base) & (F.col("batch_id") < batch_id))
    if base >= 0:
        kept = spark.read.schema("source STRING, external_id STRING, payload_hash STRING, batch_id BIGINT, bucket INT")
        rows = rows.unionByName(kept.parquet(f"{log_path}-snapshots/upto={base}").select(*columns))
    if touched is not None:
        rows = rows.filter(F.col("bucket").isin(touched))
    return _hashes(rows)


def append_changes(spark: SparkSession, batch: DataFrame, batch_id: int, log_path: str) -> None:
    """Write the change log of one micro-batch (``source, external_id, seq, payload, payload_hash``)."""
    if batch_id and batch_id % COMPACT == 0:
        stored_hashes(spark, log_path, batch_id).write.mode("overwrite").partitionBy("bucket").parquet(
            f"{log_path}-snapshots/upto={batch_id - 1}")
    last = written(last_per_key(batch).withColumn("bucket", bucket()), "last")
    touched = [r["bucket"] for r in last.select("bucket").distinct().collect()]  # BUCKETS at most
    known = stored_hashes(spark, log_path, batch_id, touched).select("bucket", *KEY, F.col("payload_hash").alias("_h"))
    differs = F.col("_h").isNull() | (F.col("low_hash") != F.col("_h")) | (F.col("high_hash") != F.col("_h"))
    changes = last.join(known, ["bucket", *KEY], "left").select(
        *KEY,
        F.when(differs, F.col("payload")).alias("payload"),
        F.when(differs, F.col("payload_hash")).alias("payload_hash"),
        F.lit(batch_id).cast("bigint").alias("run_id"),
        F.when(F.col("_h").isNull(), "new").when(differs, "changed").otherwise("unchanged").alias("status"),
        "bucket",
    )
    changes.write.mode("overwrite").partitionBy("bucket").parquet(f"{log_path}/batch_id={batch_id}")


#: Settings of a stream with keyed state: states on disk, only their changes written to the checkpoint.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Blocks of keys, each with one state: a call of Python costs milliseconds, a key in it microseconds. A checkpoint keeps its number.
STATE_BLOCKS = 1 << 14
REDUCED = f"{LOG.split(', run_id')[0]}, seq BIGINT, low_hash STRING, high_hash STRING"
DECIDED = "source STRING, external_id STRING, payload STRING, payload_hash STRING, status STRING"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is started inside; a stream keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def reduce_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per key of every Arrow batch: its last row, the smallest and largest hash. Narrow, so a key that holds a third
    of a micro-batch reaches its state as one row for each Arrow batch."""
    for rows in frames:
        rows = rows.assign(low_hash=rows["payload_hash"], high_hash=rows["payload_hash"])
        repeated = rows.duplicated(KEY, keep=False)
        if repeated.any():
            hashes = rows[repeated].groupby(KEY, dropna=False)["payload_hash"]
            rows.loc[repeated, "low_hash"], rows.loc[repeated, "high_hash"] = hashes.transform("min"), hashes.transform("max")
        last = rows.sort_values(["seq", "payload_hash"], kind="stable").drop_duplicates(KEY, keep="last")
        yield last[[*KEY, "payload", "payload_hash", "seq", "low_hash", "high_hash"]]


class LastHashes(StatefulProcessor):
    """The last hashes of a block's keys; what a micro-batch brings for each of them is told as one change."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "sources ARRAY<STRING>, external_ids ARRAY<STRING>, hashes ARRAY<STRING>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.known.get()
        known = {} if held is None else {(source, id_): old for source, id_, old in zip(*held, strict=True)}
        last, differs = {}, set()
        for r in rows:
            k = (r.source, r.external_id)
            old, seen = known.get(k), last.get(k)
            if old is None or r.low_hash != old or r.high_hash != old:
                differs.add(k)
            if seen is None or (r.seq, r.payload_hash) > (seen.seq, seen.payload_hash):
                last[k] = r
        for k, r in last.items():
            moved = k in differs
            status = "new" if k not in known else "changed" if moved else "unchanged"
            yield Row(
                source=k[0], external_id=k[1], payload=r.payload if moved else None,
                payload_hash=r.payload_hash if moved else None, status=status)
        if differs:
            known.update((k, last[k].payload_hash) for k in differs)
            self.known.update(([k[0] for k in known], [k[1] for k in known], list(known.values())))

    def close(self) -> None:
        pass


def changes(stream: DataFrame) -> DataFrame:
    """What becomes of each key of each micro-batch; unreadable records store nothing and are left out."""
    rows = readable(stream).select(*KEY, "payload", "payload_hash", F.col("seq").cast("bigint").alias("seq"))
    block = F.pmod(F.xxhash64(*KEY), F.lit(STATE_BLOCKS)).cast("int").alias("block")
    return rows.mapInPandas(reduce_batches, REDUCED).select("*", block).groupBy("block").transformWithState(
        statefulProcessor=LastHashes(), outputStructType=DECIDED, outputMode="Append", timeMode="None")


def start_upsert(stream: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch of a record stream; stops when all available input is read."""
    spark = stream.sparkSession
    spark.createDataFrame([], LOG).write.mode("ignore").parquet(f"{log_path}/batch_id=-1/bucket=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        append_changes(spark, batch, batch_id, log_path)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def start_keyed_upsert(stream: DataFrame, log_path: str, checkpoint: str) -> StreamingQuery:
    """The same on keyed state.

    The number of state partitions is that of shuffle partitions at the first start; the checkpoint keeps it, and was made
    for the STATE_BLOCKS it began with.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], LOG).write.mode("ignore").parquet(f"{log_path}/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(*KEY, "payload", "payload_hash", F.lit(batch_id).cast("bigint").alias("run_id"), "status").write.mode(
            "overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    with settings(spark, STATE_STORE):
        return (
            changes(stream).writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def current_state(spark: SparkSession, log_path: str) -> DataFrame:
    """The stored table the log amounts to: same columns and values as the batch upsert gives."""
    log = spark.read.schema(f"{LOG}, batch_id BIGINT").parquet(log_path)
    wrote = F.col("payload_hash").isNotNull()
    return log.groupBy(*KEY).agg(
        F.max_by(F.struct("payload", "payload_hash"), F.when(wrote, F.col("batch_id"))).alias("last"),
        F.min("run_id").alias("first_seen_run"),
        F.max("run_id").alias("last_seen_run"),
        F.max(F.when(wrote, F.col("run_id"))).alias("changed_run"),
    ).select(*KEY, "last.payload", "last.payload_hash", "first_seen_run", "last_seen_run", "changed_run")
