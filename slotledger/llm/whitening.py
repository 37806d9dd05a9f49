"""Whitening of embeddings by principal components.

Spark sums the vectors, then the products of their deviations from the mean: each task adds up its rows, and the rows of
those partial matrices are shuffled by their number and added where they meet. The covariance, as wide as the vectors
and so independent of the table's length, is solved on the driver: Householder reflections make it tridiagonal, bisection
with Sturm counts finds the largest eigenvalues, inverse iteration their vectors, made orthogonal again inside clusters
of close eigenvalues. The projection is broadcast and applied to every row.

Components are counted on integers: each entry c becomes floor(SCALE * c) + SHIFT. Deviations are taken as n * x - S, exact
in 64 bits, before anything is rounded or multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
MOST_WIDE = 4096  # entries of a vector: bounds the matrix that the driver solves (128 MB)
LARGEST = float(1 << 52)  # of an entry times SCALE; larger ones are an error
LEAST_SHARE = 1e-10  # eigenvalues below this part of the largest are rounding errors: no component
CLOSE = 1e-3  # eigenvalues nearer than this part of the largest form a cluster
HALVINGS = 90
STEPS = 3  # of inverse iteration
ROWS = 2048  # vectors worked on at once


class Whitening(NamedTuple):
    """Unit components (one a column) with their eigenvalues, largest first, of n vectors with sums S and trace of V."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float


def integers(column: pa.Array, width: int) -> np.ndarray:
    """Vectors without nulls as rows of integers. Entries too large for them are refused."""
    raw = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)
    scaled = np.floor(SCALE * raw)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"an entry of a vector is beyond {LARGEST / SCALE:.0f}")
    return scaled.astype(np.int64) + SHIFT


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S as integers; refused where 64 bits could not hold them."""
    if len(x) and float(np.abs(x).max()) * n + float(np.abs(sums).max()) >= 2.0**63:
        raise OverflowError("deviations of these vectors do not fit in 64 bits")
    return n * x - sums


def squares(deviation: np.ndarray) -> np.ndarray:
    """The sum of squares of each row, exact; refused where a 64-bit integer could not hold it."""
    sure = not len(deviation) or float(np.abs(deviation).max()) ** 2 * deviation.shape[1] < 2.0**62
    if sure:
        return np.einsum("ij,ij->i", deviation, deviation)
    exact = [sum(d * d for d in row) for row in deviation.tolist()]
    if max(exact) >= 1 << 63:
        raise OverflowError("a squared deviation does not fit in 64 bits")
    return np.array(exact, np.int64)


# The symmetric eigenproblem: only its size is bounded, by the width of the vectors.


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, subdiagonal and the unit Householder vectors (None: no reflection) that make ``matrix`` tridiagonal."""
    a = matrix.astype(np.float64).copy()
    n, reflections = len(a), []
    for k in range(n - 2):
        below = a[k + 1 :, k]
        length = np.linalg.norm(below)
        if length == 0 or not np.any(below[1:]):
            reflections.append(None)
            continue
        head = -np.copysign(length, below[0])
        v = below.copy()
        v[0] -= head
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = head
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def counts_below(d: np.ndarray, e: np.ndarray, points: np.ndarray, least: float) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are less than each point: the negative pivots of T - point."""
    q = d[0] - points
    count = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < least, -least, q)
        q = d[i] - points - e[i - 1] ** 2 / q
        count += q < 0
    return count


def largest_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling: all intervals are halved at once."""
    n = len(d)
    radius = np.concatenate((np.abs(e), [0])) + np.concatenate(([0], np.abs(e)))
    low, high = float((d - radius).min()), float((d + radius).max())
    least = max(np.finfo(float).tiny, np.finfo(float).eps ** 2 * max(abs(low), abs(high)) ** 2)
    wanted = n - 1 - np.arange(k)  # as many eigenvalues lie below the one that is looked for
    spare = np.finfo(float).eps * n * max(abs(low), abs(high))
    lows, highs = np.full(k, low - spare), np.full(k, high + spare)
    for _ in range(HALVINGS):
        middle = (lows + highs) / 2
        above = counts_below(d, e, middle, least) <= wanted
        lows, highs = np.where(above, middle, lows), np.where(above, highs, middle)
    return (lows + highs) / 2


def _solver(d: np.ndarray, e: np.ndarray, shift: float, least: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solve (T - shift) x = b: elimination with row exchanges, done once; pivots of zero become ``least``."""
    n = len(d)
    pivot, upper, second = (d - shift).tolist(), e.tolist() + [0.0], [0.0] * n
    factor, swapped = [0.0] * n, [False] * n
    for i in range(n - 1):
        below, across = float(e[i]), upper[i + 1]
        if abs(below) > abs(pivot[i]):
            swapped[i] = True
            factor[i] = pivot[i] / below
            pivot[i], (upper[i], held) = below, (pivot[i + 1], upper[i])
            second[i] = across
            pivot[i + 1] = held - factor[i] * upper[i]
            upper[i + 1] = -factor[i] * across
        else:
            if abs(pivot[i]) < least:
                pivot[i] = least
            factor[i] = below / pivot[i]
            pivot[i + 1] -= factor[i] * upper[i]
    if abs(pivot[-1]) < least:
        pivot[-1] = least

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.tolist()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            value = x[i]
            if i + 1 < n:
                value -= upper[i] * x[i + 1]
            if i + 2 < n:
                value -= second[i] * x[i + 2]
            x[i] = value / pivot[i]
        return np.array(x)

    return solve


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` largest eigenvalues of a covariance, falling, with unit eigenvectors as columns.

    Eigenvalues that are rounding errors beside the largest have no component. The first entry that is not near zero
    is positive, so that a matrix always gives the same signs.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).max()) if n else 0.0
    if scale == 0:
        return np.zeros(0), np.zeros((n, 0))
    a = matrix / scale
    d, e, reflections = tridiagonal(a)
    values = largest_eigenvalues(d, e, min(k, n))
    values = values[values > LEAST_SHARE * values[0]]
    least = np.finfo(float).eps * max(np.abs(d).max(), np.abs(e).max() if n > 1 else 0.0)
    draw = np.random.default_rng(n)
    vectors = np.zeros((n, len(values)))
    start = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLOSE * values[0]:
            start = j
        solve, x = _solver(d, e, float(value), least), draw.standard_normal(n)
        for _ in range(STEPS):
            x = solve(x / np.linalg.norm(x))
            for _ in range(2):  # twice is enough for orthogonality to double precision
                x -= vectors[:, start:j] @ (vectors[:, start:j].T @ x)
            x /= np.linalg.norm(x)
        vectors[:, j] = x
    for k_, v in reversed(list(enumerate(reflections))):
        if v is not None:
            tail = vectors[k_ + 1 :]
            tail -= 2 * np.outer(v, v @ tail)
    for j in range(len(values)):  # across clusters too, from the largest on
        for _ in range(2):
            vectors[:, j] -= vectors[:, :j] @ (vectors[:, :j].T @ vectors[:, j])
        vectors[:, j] /= np.linalg.norm(vectors[:, j])
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    first = np.argmax(np.abs(vectors) > 1e-6, axis=0)
    return values * scale, vectors * np.sign(vectors[first, np.arange(len(values))])


# Sums over the table


def complete(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows whose vector is not null and has finite entries only."""
    finite = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return vectors.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & finite)


def _sums(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, np.int64)
        for batch in batches:
            x = integers(batch.column(0), width)
            if len(x) and float(np.abs(x).max()) * len(x) + float(np.abs(sums).max()) >= 2.0**62:
                raise OverflowError("sums of these vectors do not fit in 64 bits")
            n += len(x)
            sums = sums + x.sum(0)
        if n:
            columns = [pa.array(np.arange(width), pa.int32()), pa.array(np.full(width, n)), pa.array(sums)]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "n", "s"])

    return run


def _products(width: int, centred: Callable[[np.ndarray], np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sum of outer products of ``centred`` rows, and under number ``width`` the sum of the rows, as rows of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                y = centred(integers(batch.column(0).slice(first, ROWS), width))
                if total is None:
                    total = np.zeros((y.shape[1] + 1, y.shape[1]))
                total[:-1] += y.T @ y
                total[-1] += y.sum(0)
                n += len(y)
        if n:
            rows = [row.tobytes() for row in total]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows)), pa.int32()), pa.array(rows, pa.binary())], ["i", "part"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of equal number, which lie in one task, added up as they come."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            row = np.frombuffer(part)
            totals[i] = totals[i] + row if i in totals else row.copy()
    columns = [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["i", "part"])


def _product_sum(rows: DataFrame, width: int, centred: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The (size + 1) x size matrix of _products over all rows; it alone comes to the driver."""
    parts = rows.select("embedding").mapInArrow(_products(width, centred), "i int, part binary")
    matrix = np.zeros((size + 1, size))
    for row in parts.repartition("i").mapInArrow(_added, "i int, part binary").collect():
        matrix[row["i"]] += np.frombuffer(row["part"])
    return matrix


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Principal components of ``rows`` (as of complete). Vectors of several lengths, or wider than MOST_WIDE, are refused."""
    spark = rows.sparkSession
    widths = rows.agg(F.min(F.size("embedding")).alias("least"), F.max(F.size("embedding")).alias("most")).first()
    width = widths["most"] or 0
    if widths["least"] != widths["most"]:
        raise ValueError(f"vectors have from {widths['least']} to {widths['most']} entries; all must have one length")
    if width > MOST_WIDE:
        raise ValueError(f"vectors have {width} entries; at most {MOST_WIDE} are supported")
    if not width:
        return Whitening(0, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0)
    summed = rows.select("embedding").mapInArrow(_sums(width), "dim int, n long, s long")
    by_dim = {r["dim"]: r for r in summed.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()}
    n, sums = by_dim[0]["n"], np.array([by_dim[i]["s"] for i in range(width)], np.int64)
    shared = spark.sparkContext.broadcast((n, sums))
    products = _product_sum(rows, width, lambda x: deviations(x, *shared.value) / shared.value[0], width)
    drift = products[-1] / n  # zero but for rounding
    covariance = products[:-1] / n - np.outer(drift, drift)
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_components(covariance, components)
    return Whitening(n, sums, vectors, values, float(np.trace(covariance)))


def _project(model: Whitening, deviation: np.ndarray) -> np.ndarray:
    return (deviation / model.n) @ model.components / np.sqrt(model.values)


def identity_error(rows: DataFrame, model: Whitening, shared: Broadcast) -> float:
    """The largest entry of the whitened vectors' covariance less the identity, measured on all rows."""
    size = len(model.values)
    whitened = lambda x: _project(shared.value, deviations(x, shared.value.n, shared.value.sums))
    products = _product_sum(rows, len(model.sums), whitened, size)
    drift = products[-1] / model.n
    return float(np.abs(products[:-1] / model.n - np.outer(drift, drift) - np.eye(size)).max()) if size else 0.0


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error: a row for each vector and component.

    Vectors that are null, or hold a null or an entry that is not finite, take no part; repeated rows and ids count as
    often as they stand. A null id stays null. Only vec_id and embedding are read. There are as many components as
    eigenvalues above LEAST_SHARE of the largest, so none for an empty table or where all vectors are equal. Vectors of
    different lengths, and entries or deviations beyond 64-bit integers, are errors.
    """
    rows = stored(complete(vectors), "vectors")
    model = fit(rows, components)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    error, size = identity_error(rows, model, shared), len(model.values)
    explained = (model.values / model.trace).tolist() if size else []
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = [vectors.schema["vec_id"].dataType.simpleString(), "int", "long", "long", "double", "double", "double"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows if size else 0, ROWS):
                ids = batch.column(0).slice(first, ROWS)
                deviation = deviations(integers(batch.column(1).slice(first, ROWS), len(model.sums)), model.n, model.sums)
                m = len(deviation)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(np.arange(m), size))),
                        pa.array(np.tile(np.arange(1, size + 1), m), pa.int32()),
                        pa.array(np.full(m * size, model.n), pa.int64()),
                        pa.array(np.repeat(squares(deviation), size), pa.int64()),
                        pa.array(_project(model, deviation).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * size, error)),
                    ],
                    names,
                )

    return rows.mapInArrow(run, ", ".join(map(" ".join, zip(names, kinds, strict=True))))
