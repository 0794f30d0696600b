"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a text: its words (A-Z lower-cased) hashed into buckets, each with weight log(1 + count) scaled to unit length
over the text, ten structure statistics, and the recorded length `n_chars` as metadata. Language, source, id and labels are
never inputs. Pairwise interactions have rank `RANK`; the sum over all pairs is half of (square of the sums - sum of the
squares), so scoring is linear in the number of features.

Defined cases: a null or empty text has no words and structure statistics of 0 and is scored by those alone; a null n_chars
counts as the text's length; equal texts with equal n_chars get equal scores; null ids are scored too and are in no fold;
repeated rows are scored one by one; no labels at all give 0.5 everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.frames import SAMPLE_ROWS, fold, labelled_sample
from docmill.llm.kernels import NOT_SPACE, Slice, later, running_hash, slices, span_hash, spans, sums_by

BUCKETS = 1 << 16
STATS = 11
RANK = 4
THRESHOLD = 0.3
_CLASSES = np.zeros((5, 256), np.float64)
_CLASSES[0, [ord(c) for c in "#*$%&|<>{}[]\\^~_=+@"]] = 1
_CLASSES[1, 0x30:0x3A] = 1
_CLASSES[2, 0x41:0x5B] = 1
_CLASSES[3, [ord(c) for c in ".,;:!?"]] = 1
_CLASSES[4, 0x80:] = 1


@dataclass
class Model:
    """bias, linear weights and factors; features BUCKETS.. are the statistics."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray


def statistics(part: Slice, declared: np.ndarray) -> np.ndarray:
    """One row of STATS values, each about 0 to 1, per text."""
    size = np.maximum(np.diff(part.bounds) - 1, 1)
    n_words = np.maximum(part.n_words, 1)
    shares = [sums_by(c[part.raw], part.bounds) / size for c in _CLASSES]
    lengths = sums_by(part.end - part.start, part.first) / n_words
    key = part.hash ^ (part.doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    again = sums_by(later(key).astype(np.int64), part.first) / n_words
    start, end = spans(part.raw != 10)
    doc = np.searchsorted(part.bounds, start, side="right") - 1
    line = span_hash(running_hash(part.raw), start, end) ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    first_line = np.searchsorted(start, part.bounds)
    n_lines = np.maximum(np.diff(first_line), 1)
    lines_again = sums_by(later(line).astype(np.int64), first_line) / n_lines
    out = np.stack([
        *shares, np.minimum(lengths / 20, 2), again, lines_again, np.log1p(part.n_words) / 10,
        np.log1p(part.n_words / n_lines) / 6, np.log1p(np.maximum(declared, 0)) / 12,
    ], axis=1)
    out[part.n_words == 0, :10] = 0
    return out


def features(part: Slice, declared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values text by text, and where each text's begin."""
    n = len(part.n_words)
    key, count = np.unique(part.doc.astype(np.int64) * BUCKETS + (part.hash % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    doc, value = key // BUCKETS, np.log1p(count)
    first = np.searchsorted(doc, np.arange(n + 1))
    norm = np.sqrt(sums_by(value * value, first))
    value = value / norm[doc] if len(doc) else value
    stats = statistics(part, declared)
    at = np.repeat(first[1:], STATS)
    number = np.insert(key % BUCKETS, at, np.tile(np.arange(BUCKETS, BUCKETS + STATS), n))
    return number, np.insert(value, at, stats.ravel()), first + np.arange(n + 1) * STATS


def margins(model: Model, number: np.ndarray, value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The machine's log-odds, in time linear in the features."""
    scaled = model.factors[number] * value[:, None]
    total, squares = sums_by(scaled, first), sums_by(scaled * scaled, first)
    return model.bias + sums_by(model.linear[number] * value, first) + 0.5 * (total * total - squares).sum(axis=1)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, batch: int = 64, rate: float = 0.1) -> Model:
    """Adaptive gradient descent on the log loss; the two classes weigh the same up to a factor of three."""
    size = BUCKETS + STATS
    rng = np.random.default_rng(7)
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.05, (size, RANK)))
    if not rows or len({y for _, _, y in rows}) < 2:
        share = float(np.clip(np.mean([y for _, _, y in rows]) if rows else 0.5, 0.02, 0.98))
        model.bias, model.factors = float(np.log(share / (1 - share))), np.zeros((size, RANK))
        return model
    seen_w, seen_v, seen_b = np.full(size, 1e-2), np.full((size, RANK), 1e-2), 1e-2
    share = np.mean([y for _, _, y in rows])
    weight = {1: 1.0, 0: float(np.clip(share / (1 - share), 1 / 3, 3))}
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), batch):
            part = [rows[i] for i in order[lo : lo + batch]]
            number, value = np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part])
            first = np.concatenate([[0], np.cumsum([len(r[0]) for r in part])])
            label = np.array([r[2] for r in part], float)
            pull = (1 / (1 + np.exp(-margins(model, number, value, first))) - label) * [weight[r[2]] for r in part] / len(part)
            doc = np.repeat(np.arange(len(part)), np.diff(first))
            scaled = model.factors[number] * value[:, None]
            push = (pull[doc] * value)[:, None] * (sums_by(scaled, first)[doc] - scaled)
            used, back = np.unique(number, return_inverse=True)
            step_w = np.bincount(back, pull[doc] * value) + 1e-5 * model.linear[used]
            step_v = np.stack([np.bincount(back, push[:, k]) for k in range(RANK)], axis=1) + 1e-5 * model.factors[used]
            seen_w[used] += step_w**2
            seen_v[used] += step_v**2
            seen_b += pull.sum() ** 2
            model.linear[used] -= rate * step_w / np.sqrt(seen_w[used])
            model.factors[used] -= rate * step_v / np.sqrt(seen_v[used])
            model.bias -= rate * pull.sum() / np.sqrt(seen_b)
    return model


def _declared(batch: pa.RecordBatch, part: Slice) -> np.ndarray:
    size = np.diff(part.bounds) - 1
    given = batch.column("n_chars").to_pylist()[part.lo : part.hi]
    return np.array([n if g is None else g for g, n in zip(given, size, strict=True)], float)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column("label").to_pylist()
        for part in slices(batch.column("text"), lower=True):
            part.words(NOT_SPACE)
            number, value, first = features(part, _declared(batch, part))
            cut = [slice(a, b) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array([number[c].astype(np.uint32).tobytes() for c in cut], pa.binary()),
                pa.array([value[c].astype(np.float32).tobytes() for c in cut], pa.binary()),
                pa.array(label[part.lo : part.hi], pa.int32()),
            ], ["number", "value", "label"])


def _with_length(docs: DataFrame) -> DataFrame:
    return docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.lit(None).cast("long"))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, rows: int = SAMPLE_ROWS) -> Model:
    """Machine fitted on at most `rows` labelled documents outside the held-out fold.

    Features are made on the executors; the driver gets those of the bounded sample only.
    """
    sample = labelled_sample(_with_length(docs), labels, "quality", folds, held, rows).select("text", "n_chars", "label")
    got = sample.mapInArrow(_featurise, "number binary, value binary, label int").collect()
    return fit(sorted(((np.frombuffer(r.number, np.uint32).astype(np.int64), np.frombuffer(r.value, np.float32).astype(float), r.label) for r in got), key=lambda r: (r[2], r[0].tobytes(), r[1].tobytes())))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with quality_score (0 to 1) and quality_kept added; other columns stay as they are."""
    docs = _with_length(docs).drop("quality_score", "quality_kept")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = docs.withColumns({"quality_score": F.lit(0.0), "quality_kept": F.lit(True)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.zeros(0)]
            for part in slices(batch.column("text"), lower=True):
                part.words(NOT_SPACE)
                got.append(1 / (1 + np.exp(-np.clip(margins(shared.value, *features(part, _declared(batch, part))), -500, 500))))
            value = np.concatenate(got)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value), pa.array(value >= threshold)], [*batch.schema.names, "quality_score", "quality_kept"])

    return docs.mapInArrow(run, fields)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = score(docs.select("doc_id", "text", *[c for c in ("n_chars",) if c in docs.columns]), train(docs, labels, folds, held))
    return scored.select(
        "doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"), F.col("quality_kept").cast("int").alias("predicted"),
    )
