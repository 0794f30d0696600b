"""Filter interaction audit: what each of five filters removes at each step of each order, by wide packed counters.

A row fails a set of filters, its mask. What happens to a row at all steps of all orders depends on its mask and its two labels
only, so every such class has one big integer: a field of `WIDTH` bits for each of the 600 steps and each of the outcomes of
`OUTCOMES`, holding 1 where the outcome is met. A part's integers, each times the number of its rows, are summed; one unpacking
of the sum gives all counts of the part. A field never carries into the next: counts stay below 2**`WIDTH`, which is checked.

Spark counts the rows of each class first (partial counts, so a part with a third of all rows is spread), which leaves at
most 128 rows a part for the sums. Copies are found by digest: the smallest id of a digest is a partial minimum, and the rows that
are that smallest id are found by a join on digest and id, so no task holds a group of copies.

Defined cases: a null text is empty, a null part the empty string; a null id has no smaller one, is no copy and has no
label; an id with several rows counts once a row, and equal texts under one id are no copies of each other; of several labels of
an id any 1 counts; an empty table gives no row; no other columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.session import written

FILTERS = "ABCDE"
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(1, len(FILTERS) + 1)]
WIDTH = 64
COPY = 1 << FILTERS.index("E")
MIN_WORDS, SPACE = 200, r"[\x20\x09-\x0D]+"
SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def _flag(letter: str, fails: Column) -> Column:
    return F.when(fails, F.lit(1 << FILTERS.index(letter))).otherwise(F.lit(0))


def text_mask(text: Column) -> Column:
    """Filters A to D that a text fails, as bits; text is not null."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    few = F.transform(F.array(counts), lambda c: _flag("A", c["n"] < MIN_WORDS) + _flag("B", 100 * c["d"] < 50 * c["n"]))[0]
    return few + _flag("C", 100 * upper.cast("long") > 2 * F.length(text)) + _flag("D", text.rlike(r"[#$%&*|]"))


def classes(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``part, mask, good, toxic, n``: rows of each class."""
    known = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").alias("label_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(docs["doc_id"], F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), text_mask(text).alias("mask"), F.sha2(text, 256).alias("digest"))
    rows = rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    rows = rows.join(known, F.col("doc_id") == F.col("label_id"), "left").select(
        "doc_id", "part", "mask", "digest", "n", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    rows = written(rows, "audit-rows")
    firsts = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    by = ["part", "mask", "good", "toxic"]
    own = rows.join(firsts, ["digest", "doc_id"], "left_semi").unionByName(rows.where("doc_id IS NULL").select("digest", *[c for c in rows.columns if c != "digest"]))
    first, all_ = own.groupBy(*by).agg(F.sum("n").alias("n")), rows.groupBy(*by).agg(F.sum("n").alias("n"))
    copies = all_.unionByName(first.withColumn("n", -F.col("n"))).groupBy(*by).agg(F.sum("n").alias("n")).withColumn("mask", F.col("mask") + F.lit(COPY))
    return first.unionByName(copies).where("n > 0")


def packed(mask: int, good: bool, toxic: bool) -> int:
    """A class's integer: field OUTCOMES x STEPS, the first lowest."""
    bits = []
    for order, step in STEPS:
        own, before = 1 << FILTERS.index(order[step - 1]), sum(1 << FILTERS.index(f) for f in order[: step - 1])
        fails, gone = bool(mask & own), bool(mask & before)
        lost = fails and not gone
        bits.append((not mask & (own | before), lost, fails and gone, mask == own, lost and good, lost and toxic))
    fields = np.array(bits, np.dtype("<u8")).T
    return int.from_bytes(np.ascontiguousarray(fields).tobytes(), "little")


def unpack(total: int) -> np.ndarray:
    """Counts by outcome and step of a sum of integers."""
    n = len(OUTCOMES) * len(STEPS)
    return np.frombuffer(total.to_bytes(n * WIDTH // 8, "little"), "<u8").astype(np.int64).reshape(len(OUTCOMES), len(STEPS))


def shapley(removed: np.ndarray) -> np.ndarray:
    """For each step what its filter removes, summed over all orders."""
    total = dict.fromkeys(FILTERS, 0)
    for (order, step), n in zip(STEPS, removed.tolist(), strict=True):
        total[order[step - 1]] += n
    return np.array([total[order[step - 1]] for order, step in STEPS], np.int64)


_made: dict[tuple, int] = {}


def _sum_part(rows: pa.Table) -> pa.Table:
    """All rows of the audit of one part; a part has at most 128 classes."""
    total = seen = 0
    for mask, good, toxic, n in zip(*(rows.column(c).to_pylist() for c in ("mask", "good", "toxic", "n")), strict=True):
        key = (mask, good, toxic)
        if key not in _made:
            _made[key] = packed(*key)
        total, seen = total + n * _made[key], seen + n
    if seen * len(ORDERS) >= 1 << (WIDTH - 1):
        raise OverflowError("more rows in a part than its sums can count")
    counts = unpack(total)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.table([
        pa.array([rows.column("part")[0].as_py()] * len(STEPS), pa.string()), pa.array([o for o, _ in STEPS], pa.string()),
        pa.array([s for _, s in STEPS], pa.int32()), *(pa.array(c) for c in counts), pa.array(shapley(counts[OUTCOMES.index("removed")])),
    ], names)


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step."""
    return classes(docs, labels, part).groupBy("part").applyInArrow(_sum_part, SCHEMA)


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), failing AS (
  SELECT part, len(w) < 200 AS A, 100 * len(list_distinct(w)) < 50 * len(w) AS B,
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) AS C,
    regexp_matches(text, '[#$%&*|]') AS D,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS E,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words LEFT JOIN (
    SELECT doc_id AS label_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
  ) ON doc_id = label_id
), filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM filters a, filters b, filters c, filters d, filters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INTEGER AS step FROM orders),
counted AS (
  SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN A WHEN 'B' THEN B WHEN 'C' THEN C WHEN 'D' THEN D ELSE E END) AS fails,
    good, toxic, count(*) AS n
  FROM failing GROUP BY ALL
), outcome AS (
  SELECT part, filter_order, step, n, good, toxic, list_contains(fails, filter_order[step]) AS own,
    len(list_filter(fails, lambda x: contains(filter_order[1:step - 1], x))) > 0 AS gone, len(fails) AS n_fails
  FROM counted, steps
), summed AS (
  SELECT part, filter_order, step,
    coalesce(sum(n) FILTER (NOT own AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (own AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (own AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (own AND n_fails = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (own AND NOT gone AND good), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER (own AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM outcome GROUP BY ALL
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM summed
"""
