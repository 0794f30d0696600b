"""JSON array files read by many tasks.

The text reader cuts files at closing braces, so it splits them like any text. Whether a brace lies inside a string, and how deep
it closes, depends on everything before it; a split is therefore summed up first (quotes, and the depth it adds if it begins
inside or outside a string), the sums of a file's splits are added up in order, and with the state at its beginning known each
split cuts out its own records. What a split border cuts in two is put together again: at most two pieces for each split move.

Elements are objects. A record that cannot be read, one that is cut off, and elements that are no objects give a row of nulls, as in
Spark's permissive mode; an empty array or file gives no row. A compressed file that cannot be split is one split. A record must
fit in memory, a file need not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.session import written

_SPLIT = "path STRING, at BIGINT"
SUMS = f"{_SPLIT}, flips BOOLEAN, outside BIGINT, inside BIGINT"
CUT = f"{_SPLIT}, kind STRING, body STRING"
RECORD, HEAD, TAIL = "record", "head", "tail"
#: What may stand before a record, and what is left of a whole array after its last one.
_BEFORE, _END = r"\A[\s,\[]*", r"\A\s*\[?\s*\]?\s*\}\z"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``path, at, value``: the file's text between closing braces, in order within a split (the file and where it begins)."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")


def _weights(value: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each piece: whether it flips between inside and outside of a string, and how many brackets it opens if it begins outside
    and if it begins inside one."""
    bare = pc.replace_substring_regex(value, r"(?s)\\.", "")
    flips = pc.count_substring(bare, '"').to_numpy(zero_copy_only=False) % 2 == 1

    def opened(text: pa.Array) -> np.ndarray:
        text = pc.replace_substring_regex(text, r'(?s)"[^"]*"?', "")
        number = [pc.count_substring(text, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in "{[]"]
        return number[0] + number[1] - number[2]

    return flips, opened(bare), opened(pc.replace_substring_regex(bare, r'(?s)\A[^"]*"?', ""))


def _closes(flips: np.ndarray, outside: np.ndarray, inside: np.ndarray, text: bool) -> tuple[np.ndarray, np.ndarray]:
    """With the state at the first piece: whether each piece ends inside a string, and the depth added by it and its brace."""
    ends = (np.cumsum(flips) + text) % 2 == 1
    begins = np.r_[text, ends[:-1]].astype(bool)
    return ends, np.where(begins, inside, outside) - ~ends


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, str, int]]:
    """Batches cut where a split ends, each with its split."""
    for batch in batches:
        path, at = batch.column("path").to_numpy(zero_copy_only=False), batch.column("at").to_numpy()
        edges = np.flatnonzero((path[1:] != path[:-1]) | (at[1:] != at[:-1])) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a), path[a], int(at[a])


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split adds up to."""
    sums: dict[tuple[str, int], list] = {}
    for rows, path, at in _runs(batches):
        flips, outside, inside = _weights(rows.column("value"))
        now = sums.setdefault((path, at), [False, 0, 0])
        parts = [_closes(flips, outside, inside, text ^ now[0]) for text in (False, True)]
        now[1] += int(parts[0][1].sum())
        now[2] += int(parts[1][1].sum())
        now[0] ^= bool(flips.sum() % 2)
    rows = [(path, at, *s) for (path, at), s in sums.items()]
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "at", "flips", "outside", "inside"])


def _states(sums: DataFrame) -> DataFrame:
    """``path, at, text, depth``: whether a split begins inside a string, and how deep; one row for each split is ordered."""
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    text = F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1
    known = sums.withColumn("text", text).withColumn("added", F.when(F.col("text"), F.col("inside")).otherwise(F.col("outside")))
    return known.select("path", "at", "text", F.coalesce(F.sum("added").over(before), F.lit(0)).alias("depth"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each split; what stands before its first and after its last border."""

    def out(split: tuple[str, int], kind: list[str], body: list[str]) -> pa.RecordBatch:
        n = len(body)
        return pa.RecordBatch.from_arrays(
            [pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n, pa.int64()), pa.array(kind, pa.string()), pa.array(body, pa.string())],
            ["path", "at", "kind", "body"])

    def rest(split: tuple[str, int], held: list[str], first: bool) -> Iterator[pa.RecordBatch]:
        if held or not first:  # a tail says that a record ended here, even if it is empty
            yield out(split, [HEAD if first else TAIL], ["".join(held)])

    split, held, first, text, depth = None, [], True, False, 0
    for rows, path, at in _runs(batches):
        if split != (path, at):
            yield from rest(split, held, first)
            split, held, first = (path, at), [], True
            text, depth = rows.column("text")[0].as_py(), rows.column("depth")[0].as_py()
        ends, added = _closes(*_weights(rows.column("value")), text)
        after = depth + np.cumsum(added)
        values, kind, body, start = rows.column("value").to_pylist(), [], [], 0
        for stop in (np.flatnonzero(~ends & (after == 1)) + 1).tolist():
            body.append("".join([*held, *(v + "}" for v in values[start:stop])]))
            kind.append(HEAD if first else RECORD)
            held, first, start = [], False, stop
        held += [v + "}" for v in values[start:]]
        text, depth = bool(ends[-1]), int(after[-1])
        if body:
            yield out(split, kind, body)
    yield from rest(split, held, first)


def _put_together(cut: DataFrame) -> DataFrame:
    """Records that lie on split borders: what is left of one split, splits without any border, the head of the next."""
    ended = F.col("kind") == TAIL
    # A split that ends records begins a new group with its tail; its head belongs to the group before.
    tails = F.count_if(ended).over(Window.partitionBy("path").orderBy("at", F.col("kind") == TAIL).rowsBetween(Window.unboundedPreceding, 0))
    grouped = cut.withColumn("part", tails).groupBy("path", "part").agg(F.array_sort(F.collect_list(F.struct("at", "body"))).alias("bodies"))
    return grouped.select(F.array_join(F.transform("bodies", lambda b: b["body"]), "").alias("body"))


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the JSON text of every element of the array files under a path."""
    pieces = _pieces(spark, path)
    states = _states(pieces.mapInArrow(_sum_up, SUMS).groupBy("path", "at").agg(
        F.max("flips").alias("flips"), F.max("outside").alias("outside"), F.max("inside").alias("inside")))
    # One short row for each split of megabytes; sent to the tasks, as a shuffle would lose the order of the pieces.
    known = pieces.join(F.broadcast(written(states, "splits")), ["path", "at"]).select("path", "at", "value", "text", "depth")
    cut = written(known.mapInArrow(_cut, CUT), "records")
    whole = cut.filter(F.col("kind") == RECORD).select("body")
    every = whole.unionByName(_put_together(cut.filter(F.col("kind") != RECORD)))
    return every.filter((F.col("body") != "") & ~F.col("body").rlike(_END)).select(F.regexp_replace("body", _BEFORE, "").alias("value"))


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Elements of JSON array files, an object each; polymorphic fields are declared VARIANT in the schema."""
    return array_elements(spark, path).select(F.from_json("value", schema).alias("r")).select("r.*")
