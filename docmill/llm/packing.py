"""Harmonic packing of tokenised documents into sequences of `CAPACITY` tokens, without a shuffle.

Class k holds pieces of length in (capacity / (k + 1), capacity / k]; each worker fills its own bins of class k with exactly k
pieces, whatever other workers do. A document is cut so that this leaves hardly any room: whole sequences first, then of the
rest, as long as a bin of its class would waste more than `WASTE` of itself, a piece of the next class's full length. Short
rests stay whole.

Bins open at the end of a worker's rows (at most k - 1 pieces for each class) are put one after another, cut at the capacity, and
the last cut into sequences of powers of two, which need no padding. So padding does not grow with the number of workers.
Sequence ids hold the worker's partition, so they are unique and a retried task gives the same ones.

Defined cases: a null or empty text is its end id alone; repeated rows, ties and null ids are packed as rows of their own; an
empty table gives no piece; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from docmill.llm.subwords import Encoder, default_vocabulary

CAPACITY = 1024
END_ID = 0
WASTE = 1 / 128
WHOLE = 32
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
OUT_ROWS = 8192


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, lo: int, hi: int) -> Piece:
        return Piece(self.doc_id, self.start + lo, self.ids[lo:hi], self.doc_tokens)


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces in order."""
    out, rest = [capacity] * (n // capacity), n % capacity
    while rest:
        k = capacity // rest
        if rest <= min(WHOLE, capacity // 2) or capacity - k * rest <= WASTE * capacity:
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


class Bins:
    """One worker's open bins by class, and the rows of closed ones."""

    def __init__(self, worker: int, capacity: int):
        self.next, self.capacity = worker << 32, capacity
        self.open: dict[int, list[Piece]] = {}
        self.rows: list[tuple] = []

    def close(self, pieces: list[Piece]) -> None:
        at = 0
        for p in pieces:
            self.rows.append((p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.doc_tokens, self.next, at))
            at += len(p.ids)
        self.next += 1

    def add(self, piece: Piece) -> None:
        k = self.capacity // len(piece.ids)
        pieces = self.open.setdefault(k, [])
        pieces.append(piece)
        if len(pieces) == k:
            self.close(self.open.pop(k))

    def finish(self) -> None:
        """Close what is open, without padding."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        total, now, room = sum(len(p.ids) for p in left), [], 0
        sizes = [self.capacity] * (total // self.capacity) + [1 << b for b in range(total.bit_length() - 1, -1, -1) if (total % self.capacity) >> b & 1]
        for size in sizes:
            now, room = [], size
            while room:
                p = left.pop(0)
                if len(p.ids) > room:
                    left.insert(0, p.cut(room, len(p.ids)))
                    p = p.cut(0, room)
                now.append(p)
                room -= len(p.ids)
            self.close(now)
        self.open = {}

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(_NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _NAMES)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: its document, place, length, checksum and document's tokens; its sequence and place there."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = Encoder.of(path), Bins(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py()), np.uint32(end_id))
                at, whole = 0, Piece(doc_id, 0, ids, len(ids))
                for n in cuts(len(ids), capacity):
                    bins.add(whole.cut(at, at + n))
                    at += n
                if len(bins.rows) >= OUT_ROWS:
                    yield bins.batch()
        bins.finish()
        yield bins.batch()

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(run, SCHEMA)
