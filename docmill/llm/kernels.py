"""Vectorised text kernels for Arrow batches: words and hashes of whole texts as numpy arrays.

Texts are handled as UTF-8 bytes, a bounded slice of the batch at a time; one longer text makes a slice of its own and is
never cut. A word's hash is a 64-bit polynomial over a fixed random byte table, taken from one running sum, so no Python
loop runs per word. Equal words have equal hashes; different ones collide with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_SYMBOLS = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes of white space: blank, tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
NOT_SPACE = ~SPACE
#: Bytes of words in the sense of letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES * 2)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def running_hash(data: np.ndarray) -> np.ndarray:
    """Sum s with s[i] over the bytes before i; span_hash turns differences into hashes."""
    power, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = _SYMBOLS[data]
    terms *= power[: len(data)]
    np.cumsum(terms, out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end), independent of where they stand."""
    _, inverse = _power_tables(len(sums))
    return mix((sums[end] - sums[start]) * inverse[start])


def word_hash(word: bytes) -> int:
    """The hash of one word, as the kernels compute it."""
    data = np.frombuffer(word, np.uint8)
    return int(span_hash(running_hash(data), np.array([0]), np.array([len(data)]))[0])


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edge[::2], edge[1::2]


class Slice:
    """Consecutive rows of a batch. data: their texts, each followed by one line feed; bounds: where each text begins."""

    def __init__(self, lo: int, texts: list[bytes], lower: bool):
        self.lo, self.hi = lo, lo + len(texts)
        joined = b"\n".join(texts) + b"\n"
        self.raw = np.frombuffer(joined, np.uint8)
        self.data = LOWER[self.raw] if lower else self.raw
        self.bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.bounds[1:])

    def words(self, table: np.ndarray) -> None:
        """Set start, end and hash of each word and first: each text's first word, and one more bound."""
        self.start, self.end = spans(table[self.data])
        self.sums = running_hash(self.data)
        self.hash = span_hash(self.sums, self.start, self.end)
        self.first = np.searchsorted(self.start, self.bounds)
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.n_words)), self.n_words)


def slices(texts: pa.Array, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """A batch's texts (null: empty) in slices of about limit bytes."""
    rows = [t.encode() if t else b"" for t in texts.to_pylist()]
    lo = size = 0
    for i, text in enumerate(rows):
        if size and size + len(text) > limit:
            yield Slice(lo, rows[lo:i], lower)
            lo, size = i, 0
        size += len(text)
    if rows:
        yield Slice(lo, rows[lo:], lower)


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs [first[i], first[i + 1]); 0 for an empty run."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, one place of each, and for every value its number among them."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], order[new], number


def repeated(key: np.ndarray) -> np.ndarray:
    """Which values occur twice or more."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def later(key: np.ndarray) -> np.ndarray:
    """Which values have occurred before."""
    order = np.argsort(key, kind="stable")
    out = np.zeros(len(key), bool)
    out[order[1:]] = key[order][1:] == key[order][:-1]
    return out
