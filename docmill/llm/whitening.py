"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its triangular factor.

Entries become whole numbers, so counts, sums and the scatter are exact whatever the partitioning or retries. Vectors are centred
on the whole part of the mean before they are multiplied; what is left of the mean, less than one, is taken out of the
sum of products in whole numbers too. Products are multiplied as doubles in blocks so small that they stay exact. Partial sums, a
`dimensions x dimensions` matrix each, meet in many tasks, then in one; only the last matrix reaches the driver.

There the covariance V is factored once, V = L L' with the largest remaining pivot first; columns stop where what remains is
rounding. Plane rotations then make the columns of L orthogonal to each other in place, without forming L' L: their squared
norms are the eigenvalues of V, and they themselves over their norms its components. Small eigenvalues keep their leading
digits, which a decomposition of V would lose.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped; components without variance are
not returned (equal vectors, or one row, give no rows); of equal eigenvalues any basis is as good; repeated rows count once each;
null ids are kept; an empty table gives no rows; vectors of several lengths, or entries beyond 2**40, are an error; a
deviation beyond a long is null. No other columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LIMIT = 1 << 40
BLOCK_ROWS = 4096
_SUMS = "n long, width int, sums array<decimal(38,0)>"
SCHEMA = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the usable rows of a batch and their vectors as whole numbers."""
    column = column.cast(pa.list_(pa.float64())) if len(column) else pa.array([], pa.list_(pa.float64()))
    here = np.flatnonzero(~np.asarray(column.is_null()))
    column = column.take(pa.array(here, pa.int64()))
    sizes = np.diff(np.asarray(column.offsets))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    bad = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(~np.isfinite(flat), out=bad[1:])
    ends = np.cumsum(sizes)
    good = bad[ends] == bad[ends - sizes]
    if len(set(sizes[good].tolist())) > 1:
        raise ValueError("vectors differ in length")
    width = int(sizes[good][0]) if good.any() else 0
    value = np.floor(SCALE * flat[np.repeat(good, sizes)]) + SHIFT
    if len(value) and np.abs(value).max() >= LIMIT:
        raise OverflowError("an entry is beyond what whole sums allow")
    return here[good], value.astype(np.int64).reshape(int(good.sum()), width)


def _merge(total: tuple | None, more: tuple) -> tuple:
    """Sum of two partial sums (rows, width, values); none is empty."""
    if total is None or not total[0]:
        return more
    if not more[0]:
        return total
    if total[1] != more[1]:
        raise ValueError("vectors differ in length")
    return total[0] + more[0], total[1], total[2] + more[2]


def _row(total: tuple | None) -> pa.RecordBatch:
    n, width, sums = total or (0, 0, np.zeros(0, object))
    exact = Context(prec=38)
    return pa.RecordBatch.from_arrays([
        pa.array([n], pa.int64()), pa.array([width], pa.int32()),
        pa.array([[exact.create_decimal(int(x)) for x in sums]], pa.list_(pa.decimal128(38, 0))),
    ], ["n", "width", "sums"])


def _gather(partials: DataFrame) -> tuple[int, int, np.ndarray]:
    """The sum of all partial sums; they meet in as many tasks as a shuffle has, then in one."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for n, width, sums in zip(*(batch.column(c) for c in ("n", "width", "sums")), strict=True):
                total = _merge(total, (n.as_py(), width.as_py(), np.array([int(x) for x in sums.as_py()], object)))
        yield _row(total)

    met = partials.repartition("task").select("n", "width", "sums").mapInArrow(add, _SUMS)
    last = met.where("n > 0").repartition(1).mapInArrow(add, _SUMS).first()
    return (last.n, last.width, np.array([int(x) for x in last.sums], object)) if last and last.n else (0, 0, np.zeros(0, object))


def _partials(vectors: DataFrame, of) -> DataFrame:
    """One row per task: the sum of of(block) over blocks of its usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            _, x = whole(batch.column("embedding"))
            for lo in range(0, len(x), BLOCK_ROWS):
                part = x[lo : lo + BLOCK_ROWS]
                total = _merge(total, (len(part), x.shape[1], of(part).ravel()))
        if total:
            yield _row(total)

    return vectors.select("embedding").mapInArrow(run, _SUMS).withColumn("task", F.spark_partition_id())


def exact_product(y: np.ndarray) -> np.ndarray:
    """y' y in whole numbers."""
    most = int(np.abs(y).max()) if y.size else 0
    if most * most * max(len(y), 1) < 1 << 53:  # every partial sum is a whole number that a double holds
        d = y.astype(float)
        return (d.T @ d).astype(np.int64).astype(object)
    if most < 1 << 40 and len(y) > 1 and most * most < 1 << 52:
        half = len(y) // 2
        return exact_product(y[:half]) + exact_product(y[half:])
    big = y.astype(object)
    return big.T @ big


@dataclass
class Whitening:
    """Rows fitted on, sums by dimension, eigenvalues by falling size, components as columns, trace of the covariance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with V = L L' up to rounding, a column for each pivot that is more than rounding; rows in V's order."""
    v, d = v.copy(), len(v)
    columns, left = [], np.ones(d, bool)
    floor = d * np.finfo(float).eps * max(float(np.diag(v).max(initial=0)), 0)
    while left.any():
        rest = np.where(left, np.diag(v), -1.0)
        at = int(np.argmax(rest))
        if rest[at] <= floor:
            break
        column = np.where(left, v[:, at], 0.0) / np.sqrt(rest[at])
        columns.append(column)
        v -= np.outer(column, column)
        left[at] = False
    return np.stack(columns, axis=1) if columns else np.zeros((d, 0))


def one_sided_jacobi(columns: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns rotated in pairs until each is orthogonal to all others, to rounding."""
    c, r = columns.copy(), columns.shape[1]
    bound = np.finfo(float).eps * max(len(c), 1)
    for _ in range(sweeps):
        turned = False
        for p in range(r - 1):
            for q in range(p + 1, r):
                a, b, g = c[:, p] @ c[:, p], c[:, q] @ c[:, q], c[:, p] @ c[:, q]
                if abs(g) <= bound * np.sqrt(a * b):
                    continue
                turned = True
                z = (b - a) / (2 * g)
                t = np.copysign(1.0, z) / (abs(z) + np.hypot(1.0, z))
                cos = 1 / np.hypot(1.0, t)
                c[:, p], c[:, q] = cos * c[:, p] - cos * t * c[:, q], cos * t * c[:, p] + cos * c[:, q]
        if not turned:
            break
    return c


def decompose(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and unit eigenvectors as columns; those of value zero are left out."""
    columns = one_sided_jacobi(pivoted_cholesky(v))
    norms = np.sqrt((columns * columns).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, columns[:, order] / norms[order]


def fit(vectors: DataFrame) -> Whitening:
    """Whitening of all usable vectors: one pass for the sums, one for the centred scatter."""
    n, width, sums = _gather(_partials(vectors, lambda x: x.sum(axis=0).astype(object)))
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((0, 0)), 0.0)
    middle = np.array([int(s) // n for s in sums], np.int64)
    _, _, products = _gather(_partials(vectors, lambda x: exact_product(x - middle)))
    rest = np.array([int(s) - n * int(m) for s, m in zip(sums, middle, strict=True)], object)
    scatter = n * products.reshape(width, width) - np.outer(rest, rest)
    v = np.array([[float(Fraction(int(x), n * n)) for x in line] for line in scatter]).reshape(width, width)
    values, components = decompose(v)
    return Whitening(n, sums, values, components, float(Fraction(sum(int(scatter[i, i]) for i in range(width)), n * n)))


def project(model: Whitening, x: np.ndarray, count: int) -> tuple[list[int | None], np.ndarray]:
    """Exact deviations of whole vectors from the mean, and their whitened coordinates."""
    far = int(np.abs(x).max(initial=0)) + max((abs(int(s)) // model.n for s in model.sums), default=0) + 1
    if (model.n * far) ** 2 * max(x.shape[1], 1) < 1 << 63:
        apart = model.n * x - model.sums.astype(np.int64)
        squares = (apart * apart).sum(axis=1).tolist()
    else:
        apart = model.n * x.astype(object) - model.sums
        squares = [s if s < 1 << 63 else None for s in (apart * apart).sum(axis=1).tolist()] if x.shape[1] else [0] * len(x)
    centred = (apart / model.n).astype(float)
    return squares, centred @ (model.components[:, :count] / np.sqrt(model.values[:count]))


def identity_error(vectors: DataFrame, model: Whitening, count: int) -> float:
    """Largest absolute entry of (covariance of the whitened coordinates - identity), measured over all usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            _, x = whole(batch.column("embedding"))
            if len(x):
                w = project(model, x, count)[1]
                first, second = first + w.sum(axis=0), second + w.T @ w
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(count + 1), count), pa.int32()), pa.array(np.tile(np.arange(count), count + 1), pa.int32()),
            pa.array(np.concatenate([first, second.ravel()]))], ["i", "j", "s"])

    got = vectors.select("embedding").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    means = np.zeros((count + 1, count))
    for r in got:
        means[r.i, r.j] = r.s / model.n
    return float(np.abs(means[1:] - np.outer(means[0], means[0]) - np.eye(count)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    spark, schema = vectors.sparkSession, SCHEMA.format(id=kind)
    model = fit(vectors)
    count = min(components, len(model.values))
    if not count:
        return spark.createDataFrame([], schema)
    error = identity_error(vectors, model, count)
    share = model.values[:count] / model.trace
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = whole(batch.column("embedding"))
            if not len(at):
                continue
            squares, w = project(model, x, count)
            rows = len(at) * count
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(np.repeat(at, count))), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(at))),
                pa.array(np.full(rows, model.n)), pa.array([s for s in squares for _ in range(count)], pa.int64()),
                pa.array(w.ravel()), pa.array(np.tile(share, len(at))), pa.array(np.full(rows, error))], names)

    return vectors.select("vec_id", "embedding").mapInArrow(run, schema)
