"""Quality rules: surface counts that reject a text outright, then a calibrated logistic regression on hashed n-grams.

Words are runs without ASCII white space. The regression sees one- and two-word n-grams (A-Z lower-cased) and three-character
n-grams, hashed into buckets of their own; each kind's values are shares that sum to one, so long texts weigh like short ones.
A fifth of the bounded labelled sample is kept back to calibrate the margins (Platt). A text is kept if no rule rejects it and
its calibrated probability reaches `THRESHOLD`.

Defined cases: a null or empty text has no words and no n-grams, fails and is not kept; repeated rows and ties are judged alike,
whatever rows stand beside them; an empty table gives no row; no labels give probability 0.5; extra columns are left alone by `judge` (columns named like the added ones are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docmill.llm.frames import SAMPLE_ROWS, labelled_sample, with_fields
from docmill.llm.kernels import LOWER, NOT_SPACE, Slice, later, mix, repeated, running_hash, slices, span_hash, spans, sums_by

BUCKETS = 1 << 16
KINDS = 3
SCALE = 8.0
THRESHOLD = 0.3
MIN_WORDS, REPEAT_PERCENT = 50, 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_DOC = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Model:
    """bias and weights of the regression; slope and shift of the calibration."""

    bias: float
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0


def rule_counts(part: Slice) -> dict[str, np.ndarray]:
    """The five counts of each text. part.words(NOT_SPACE) has run on the texts as they stand."""
    lead = (part.data & 0xC0) != 0x80
    in_words = lead & NOT_SPACE[part.data]
    salt = part.doc.astype(np.uint64) * _DOC
    windows = np.flatnonzero(part.doc[2:] == part.doc[:-2]) if len(part.doc) > 2 else np.zeros(0, np.int64)
    h = part.hash
    window = mix(mix(h[windows] * np.uint64(3) + h[windows + 1]) * np.uint64(5) + h[windows + 2]) ^ salt[windows]
    twice = windows[repeated(window)]
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[twice + k] = True
    start, end = spans(part.data != 10)
    has_word = np.zeros(len(start), bool)
    has_word[np.searchsorted(start, part.start, side="right") - 1] = True
    start, end = start[has_word], end[has_word]
    doc = np.searchsorted(part.bounds, start, side="right") - 1
    again = later(span_hash(part.sums, start, end) ^ (doc.astype(np.uint64) * _DOC))
    return {
        "n_words": part.n_words.astype(np.int64),
        "word_chars": sums_by(in_words.view(np.int8), part.bounds),
        "n_symbols": sums_by(_SYMBOL[part.data].view(np.int8), part.bounds),
        "n_dup_lines": np.bincount(doc[again], minlength=len(part.n_words)).astype(np.int64),
        "n_repeat_words": sums_by(covered.view(np.int8), part.first),
    }


def grams(part: Slice) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per kind: bucket of each n-gram, text by text, and where each text's begin."""
    part.words(NOT_SPACE)
    n = len(part.n_words)
    pair = np.flatnonzero(part.doc[1:] == part.doc[:-1]) if len(part.doc) > 1 else np.zeros(0, np.int64)
    pairs = mix(part.hash[pair] * np.uint64(3) + part.hash[pair + 1]) % np.uint64(BUCKETS)
    points = np.frombuffer(part.data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    lead = np.zeros(len(part.data) + 1, np.int64)
    np.cumsum((part.data & 0xC0) != 0x80, out=lead[1:])
    bounds = lead[part.bounds]
    triple = (points[:-2] * np.uint64(1 << 42) ^ points[1:-1] * np.uint64(1 << 21) ^ points[2:]) if len(points) > 2 else points[:0]
    triples = ((triple * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    # A text's triples end before the line feed that closes it, so none reaches into the next text.
    inside = np.ones(len(points), bool)
    for back in range(3):
        at = bounds[1:] - 1 - back
        inside[at[at >= 0]] = False
    triples = triples[inside[: len(triples)]]
    first = np.concatenate([[0], np.cumsum(np.maximum(np.diff(bounds) - 3, 0))])
    return [
        ((part.hash % np.uint64(BUCKETS)).astype(np.int64), part.first),
        (pairs.astype(np.int64) + BUCKETS, np.searchsorted(part.doc[pair], np.arange(n + 1))),
        (triples + 2 * BUCKETS, first),
    ]


def margins(model: Model, kinds: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return model.bias + sum(SCALE * sums_by(model.weights[g], f) / np.maximum(np.diff(f), 1) for g, f in kinds)


def probabilities(model: Model, kinds: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Calibrated chance of each text, rounded so that it does not depend on the texts summed before it."""
    z = model.slope * margins(model, kinds) + model.shift
    return np.round(1 / (1 + np.exp(-np.clip(z, -500, 500))), 9)


def _descend(rows, label, epochs: int = 30, batch: int = 64, rate: float = 0.3) -> Model:
    model, seen, seen_b = Model(0.0, np.zeros(KINDS * BUCKETS)), np.full(KINDS * BUCKETS, 1e-4), 1e-4
    rng = np.random.default_rng(11)
    share = float(label.mean())
    weight = np.where(label == 1, 1.0, np.clip(share / max(1 - share, 1e-9), 1 / 4, 4))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), batch):
            part = order[lo : lo + batch]
            number, value = np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part])
            first = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in part])])
            z = model.bias + sums_by(model.weights[number] * value, first)
            pull = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - label[part]) * weight[part] / len(part)
            used, back = np.unique(number, return_inverse=True)
            step = np.bincount(back, np.repeat(pull, np.diff(first)) * value) + 1e-5 * model.weights[used]
            seen[used] += step**2
            seen_b += pull.sum() ** 2
            model.weights[used] -= rate * step / np.sqrt(seen[used])
            model.bias -= rate * pull.sum() / np.sqrt(seen_b)
    return model


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Regression on four fifths of the rows, calibration on the rest."""
    label = np.array([r[2] for r in rows], float)
    if len(rows) < 10 or label.min() == label.max():
        share = float(np.clip(label.mean() if len(rows) else 0.5, 0.02, 0.98))
        return Model(float(np.log(share / (1 - share))), np.zeros(KINDS * BUCKETS))
    last = np.arange(len(rows)) % 5 == 4
    model = _descend([r for r, x in zip(rows, last, strict=True) if not x], label[~last])
    z = np.array([model.bias + model.weights[r[0]] @ r[1] for r, x in zip(rows, last, strict=True) if x])
    y, n = label[last], [np.sum(label[last] == 0), np.sum(label[last] == 1)]
    aim = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's method on the two calibration values
        p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -30, 30)))
        w = p * (1 - p) + 1e-6
        hess = np.array([[np.sum(w * z * z) + 1e-3, np.sum(w * z)], [np.sum(w * z), np.sum(w) + 1e-3]])
        move = np.linalg.solve(hess, [np.sum((p - aim) * z), np.sum(p - aim)])
        slope, shift = slope - np.clip(move[0], -1, 1), shift - np.clip(move[1], -1, 1)
    model.slope, model.shift = float(max(slope, 1e-3)), float(shift)
    return model


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column("label").to_pylist()
        for part in slices(batch.column("text"), lower=True):
            kinds, number, value = grams(part), [], []
            for i in range(len(part.n_words)):
                own = [np.unique(g[f[i] : f[i + 1]], return_counts=True) + (max(f[i + 1] - f[i], 1),) for g, f in kinds]
                number.append(np.concatenate([x[0] for x in own]).astype(np.uint32).tobytes())
                value.append(np.concatenate([SCALE * x[1] / x[2] for x in own]).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.binary()), pa.array(value, pa.binary()), pa.array(label[part.lo : part.hi], pa.int32())], ["number", "value", "label"])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Model from at most `rows` labelled documents; their n-grams are counted on the executors."""
    sample = labelled_sample(docs, labels, "quality", rows=rows).select("text", "label")
    got = sample.mapInArrow(_featurise, "number binary, value binary, label int").collect()
    got = sorted(got, key=lambda r: (r.number, r.value, r.label))
    return fit([(np.frombuffer(r.number, np.uint32).astype(np.int64), np.frombuffer(r.value, np.float32).astype(float), r.label) for r in got])


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with the counts, base_failed, probability and kept added."""
    added = {**dict.fromkeys(COUNTS, "long"), "base_failed": "boolean", "probability": "double", "kept": "boolean"}
    docs = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = with_fields(docs, added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                part.words(NOT_SPACE)
                counts = rule_counts(part)
                part.data = LOWER[part.raw]
                chance = probabilities(shared.value, grams(part))
                failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > REPEAT_PERCENT * counts["n_words"])
                rows = batch.slice(part.lo, part.hi - part.lo)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, *(pa.array(counts[c]) for c in COUNTS), pa.array(failed), pa.array(chance), pa.array(~failed & (chance >= threshold))],
                    [*rows.schema.names, *added],
                )

    return docs.mapInArrow(run, fields)
