"""SimHash near-duplicates: 64-bit fingerprints, linked where at most three bits differ, by hashing balls of half the radius.

The radius is 3, so two linked fingerprints differ in at most two bits outside the 16-bit block in which they differ most. Each
distinct fingerprint emits, for each of the four blocks left out, all values within half of those two bits of its other 48
bits: 4 * 49 variants. A linked pair meets in the variant half-way. (Balls over all 64 bits would need 2,081 variants a
fingerprint.) Variants are shuffled and sorted; in one variant's group the 48-bit parts are at most two bits apart, so

* fingerprints equal in the left-out block are all linked: a chain joins them,
* those one bit apart there are all linked (2 + 1): one pair for each two neighbouring block values joins them,
* those three bits apart there are linked if their 48 bits are equal: block values are looked up through the 560 masks of
  three bits.

Every emitted link is verified; a group costs time in proportion to its size, never all its pairs, and components are exact.

Defined cases: null or empty text and text without words has fingerprint 0, which links like any other; fewer than three words
make one shingle; equal texts share a fingerprint and are one node whatever their number; null ids never name a component
unless it has no other; repeated rows are each returned; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.components import components, stars
from docmill.llm.frames import whole_row, with_fields
from docmill.session import written

SHINGLE = 3
RADIUS = 3
SEED = 42
LINK_BUFFER = 1 << 17
_BITS16 = np.uint64(0xFFFF)
_TRIPLES = np.array([(1 << a) | (1 << b) | (1 << c) for a, b, c in combinations(range(16), 3)], np.int64)


def fingerprint(text: str | None) -> int:
    """Unsigned fingerprint of one text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    grams = zip(*(words[k:] for k in range(SHINGLE)), strict=False) if len(words) >= SHINGLE else [words]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    values = np.array([digest(join(g), SEED) for g in grams], np.uint64)
    count = np.zeros(64, np.int64)
    for lo in range(0, len(values), 65536):
        bits = np.unpackbits(values[lo : lo + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(values), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame) -> DataFrame:
    """The rows with `fingerprint_bits`, the fingerprint as a signed number, added."""
    docs = docs.drop("fingerprint_bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, "fingerprint_bits"])

    return docs.mapInArrow(run, with_fields(docs, {"fingerprint_bits": "long"}))


def _outside(value: np.ndarray, block: int) -> np.ndarray:
    """The 48 bits outside a block, pushed together, with the block's number above them."""
    low = np.uint64(16 * block)
    below = value & ((np.uint64(1) << low) - np.uint64(1))
    above = (value >> low >> np.uint64(16)) << low
    return below | above | np.uint64(block << 48)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(48, dtype=np.uint64)])
    for batch in batches:
        every = batch.column("bits").to_numpy(zero_copy_only=False).astype(np.int64)
        for lo in range(0, len(every), 512):
            own = every[lo : lo + 512]
            key = np.concatenate([(_outside(own.view(np.uint64), k)[:, None] ^ flips).ravel() for k in range(4)])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.tile(np.repeat(own, 49), 4))], ["variant", "bits"])


def _met(variant: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links between the fingerprints of each of the (whole, consecutive) groups of one variant."""
    edge = np.flatnonzero(np.r_[True, variant[1:] != variant[:-1]])
    size = np.diff(np.r_[edge, len(variant)])
    many = np.repeat(size > 1, size)
    if not many.any():
        return bits[:0], bits[:0]
    group = np.repeat(np.arange(len(size)), size)[many]
    variant, value = variant[many], bits[many].view(np.uint64)
    block = (variant >> 48).astype(np.uint64)
    inside = ((value >> (block * np.uint64(16))) & _BITS16).astype(np.int64)
    slot = (group << 16) | inside
    order = np.argsort(slot, kind="stable")
    slot, value, variant, block = slot[order], value[order], variant[order], block[order]
    same = slot[1:] == slot[:-1]
    left, right = [value[:-1][same]], [value[1:][same]]
    head = np.flatnonzero(np.r_[True, ~same])
    classes, rep = slot[head], value[head]

    def neighbours(classes, rep, masks):
        for mask in masks:
            other = classes ^ mask
            at = np.minimum(np.searchsorted(classes, other), len(classes) - 1)
            hit = (classes[at] == other) & (classes < other)
            left.append(rep[hit])
            right.append(rep[at[hit]])

    neighbours(classes, rep, [1 << j for j in range(16)])
    centre = np.zeros(len(value), bool)
    for k in range(4):
        own = block == k
        centre[own] = _outside(value[own], k) == variant[own].view(np.uint64)
    middle, rep = slot[centre], value[centre]
    if len(middle) > 1:
        twin = np.flatnonzero(middle[1:] >> 16 == middle[:-1] >> 16)
        if len(twin):
            keep = np.unique(np.r_[twin, twin + 1])
            neighbours(middle[keep], rep[keep], _TRIPLES)
    u, v = np.concatenate(left), np.concatenate(right)
    close = np.bitwise_count(u ^ v) <= RADIUS
    return u[close].view(np.int64), v[close].view(np.int64)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the sorted variants of a task, thinned to stars with the same components."""
    none = np.zeros(0, np.int64)
    variant, bits, held_u, held_v = none, none, none, none

    def out(u, v):
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        variant = np.r_[variant, batch.column("variant").to_numpy(zero_copy_only=False)]
        bits = np.r_[bits, batch.column("bits").to_numpy(zero_copy_only=False)]
        cut = int(np.searchsorted(variant, variant[-1])) if len(variant) else 0
        if not cut:
            continue
        u, v = _met(variant[:cut], bits[:cut])
        variant, bits, held_u, held_v = variant[cut:], bits[cut:], np.r_[held_u, u], np.r_[held_v, v]
        if len(held_u) > LINK_BUFFER:
            held_u, held_v = stars(held_u, held_v)
            if len(held_u) > LINK_BUFFER // 2:
                yield out(held_u, held_v)
                held_u, held_v = none, none
    if len(variant):
        u, v = _met(variant, bits)
        held_u, held_v = np.r_[held_u, u], np.r_[held_v, v]
    if len(held_u):
        yield out(*stars(held_u, held_v))


def fingerprint_classes(prints: DataFrame) -> DataFrame:
    """(bits, low, root, component_id) per distinct fingerprint of rows (doc_id, bits): its smallest id, its component's
    smallest fingerprint and id."""
    spark = prints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = written(prints.groupBy("bits").agg(F.min("doc_id").alias("low")), "fingerprints")
    variants = nodes.select("bits").repartition(parts, "bits").mapInArrow(_variants, "variant long, bits long")
    links = variants.repartition("variant").sortWithinPartitions("variant").mapInArrow(_links, "u long, v long")
    found = nodes.join(components(links).withColumnRenamed("node", "bits"), "bits", "left")
    found = found.withColumn("root", F.coalesce("root", "bits"))
    least = found.groupBy("root").agg(F.min("low").alias("component_id"))
    return written(found.join(least, "root").select("bits", "low", "root", "component_id"), "classes")


def _prints(docs: DataFrame) -> DataFrame:
    """Write (doc_id, text_key, bits) of every row; equal texts have equal keys."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return written(with_fingerprint(keyed).select("doc_id", "text_key", F.col("fingerprint_bits").alias("bits")), "prints")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = _prints(docs)
    classes = fingerprint_classes(prints).select("bits", "component_id")
    return prints.join(classes, "bits", "left").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One whole row per component: that of its smallest id (of rows with this id the smallest text key; of equal rows any one)."""
    prints = _prints(docs)
    classes = fingerprint_classes(prints).select("bits", "root", "component_id")
    heads = prints.join(classes, "bits").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = heads.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("head")).select(F.col("head.doc_id").alias("keep_id"), F.col("head.text_key").alias("keep_key"))
    rows = docs.select(whole_row(docs), F.xxhash64("text").alias("text_key"))
    kept = rows.join(chosen, F.col("row.doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_key") == F.col("keep_key")))
    return kept.dropDuplicates(["keep_id", "keep_key"]).select("row.*")
