"""Whitening of embeddings by their principal components.

Entries become whole numbers, ``x = floor(64 c) + 1000000``, so that sums are exact. Each
distinct vector counts once. Tasks add up the scatter of vectors that are centred already;
the driver holds one matrix of dimension by dimension. It is factored by pivoted Cholesky,
``P'VP = LL'``, and one-sided Jacobi rotations make the columns of L orthogonal: the squared
norms of the rotated columns are the eigenvalues, and the normalised columns the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.staging import stage

SHIFT = 1_000_000
EDGE = 9e18  # larger multiples of an entry count as this one
LOW = (1 << 32) - 1


@dataclass(frozen=True)
class Whitening:
    """What a fit has found: the distinct vectors' count and exact sums, and the components by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray  # dimension x components
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def middle(self) -> np.ndarray:
        """The whole number nearest to each mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part is taken off exactly, then the rest of the mean."""
        middle = self.middle
        rest = np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, middle, strict=True)])
        return (x - middle).astype(np.float64) - rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None where a long cannot hold it."""
        middle = self.middle
        y = x - middle
        rest = np.array([s - self.n * int(m) for s, m in zip(self.sums, middle, strict=True)], np.int64)
        reach = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if reach * reach * max(1, x.shape[1]) < 1 << 63:
            return ((self.n * y - rest) ** 2).sum(1).tolist()
        exact = [sum((self.n * int(v) - int(r)) ** 2 for v, r in zip(row, rest, strict=True)) for row in y]
        return [v if v < 1 << 63 else None for v in exact]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Rows of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension)


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with ``v = L L'``; rows in the order of ``v``, columns in the order of the pivots, as many as the rank."""
    d = len(v)
    left = np.diag(v).copy()
    floor = d * np.finfo(float).eps * left.max(initial=0.0)
    lower = np.zeros((d, d))
    open_rows = np.ones(d, bool)
    for k in range(d):
        pivot = int(np.argmax(np.where(open_rows, left, -np.inf)))
        if left[pivot] <= floor:
            return lower[:, :k]
        open_rows[pivot] = False
        column = np.where(open_rows, v[:, pivot] - lower[:, :k] @ lower[pivot, :k], 0.0) / np.sqrt(left[pivot])
        column[pivot] = np.sqrt(left[pivot])
        lower[:, k] = column
        left = np.where(open_rows, left - column * column, 0.0)
    return lower


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of 0..n-1 once, in rounds of disjoint pairs."""
    size = n + n % 2
    seats = np.arange(size)
    for _ in range(size - 1):
        a, b = seats[: size // 2], seats[size // 2 :][::-1]
        real = (a < n) & (b < n)
        yield a[real], b[real]
        seats = np.concatenate((seats[:1], seats[-1:], seats[1:-1]))


def one_sided_jacobi(lower: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components) of ``L L'``, by falling eigenvalue."""
    a = lower.copy()
    for _ in range(sweeps):
        worst = 0.0
        for p, q in _rounds(a.shape[1]):
            x, y = a[:, p], a[:, q]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(alpha * beta)
            turn = np.abs(gamma) > 1e-15 * size
            worst = max(worst, float((np.abs(gamma)[turn] / size[turn]).max(initial=0.0)))
            safe = np.where(turn, gamma, 1.0)
            zeta = (beta - alpha) / (2 * safe)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            a[:, p], a[:, q] = c * x - s * y, s * x + c * y
        if worst < 1e-14:
            break
    values = (a * a).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], a[:, order] / np.sqrt(values[order])


def whole(embeddings: DataFrame, vector: str) -> DataFrame:
    """The rows that count, with their vector as whole numbers in ``x``."""
    raw = F.col(vector)
    bad = F.exists(raw, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    scaled = lambda e: F.least(F.greatest(F.lit(64.0) * e.cast("double"), F.lit(-EDGE)), F.lit(EDGE))
    x = F.transform(raw, lambda e: F.floor(scaled(e)).cast("long") + F.lit(SHIFT).cast("long"))
    return embeddings.filter(raw.isNotNull() & ~bad).withColumn("x", x)


def _sums(vectors: DataFrame, dimension: int) -> list[int]:
    """Exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = pa.array(np.arange(dimension))
        for batch in batches:
            x = matrix(batch.column("x"), dimension)
            yield pa.record_batch([places, pa.array((x >> 32).sum(0)), pa.array((x & LOW).sum(0))], names=["dim", "high", "low"])

    parts = vectors.select("x").mapInArrow(run, "dim long, high long, low long").groupBy("dim").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    by_dim = {r["dim"]: (r["high"] << 32) + r["low"] for r in parts.collect()}  # one row a dimension
    return [by_dim[k] for k in range(dimension)]


def _moments(vectors: DataFrame, dimension: int, project, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, sums of products) of ``project`` of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            y = project(matrix(batch.column("x"), dimension))
            first += y.sum(0)
            second += y.T @ y
        i, j = np.triu_indices(width)
        i, j, cells = np.concatenate((np.full(width, -1), i)), np.concatenate((np.arange(width), j)), np.concatenate((first, second[i, j]))
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(cells)], names=["i", "j", "cell"])

    first, second = np.zeros(width), np.zeros((width, width))
    for r in vectors.select("x").mapInArrow(run, "i long, j long, cell double").groupBy("i", "j").agg(F.sum("cell").alias("cell")).collect():
        if r["i"] < 0:
            first[r["j"]] = r["cell"]
        else:
            second[r["i"], r["j"]] = second[r["j"], r["i"]] = r["cell"]
    return first, second


def fit(vectors: DataFrame, most: int = 16) -> Whitening | None:
    """Fit on ``vectors`` (x), each of them once; None without a vector. ``most`` bounds the components."""
    vectors = stage(vectors.select("x").distinct(), "vectors")
    n = vectors.count()
    if not n:
        return None
    dimension = len(vectors.first()["x"])
    known = Whitening(n, _sums(vectors, dimension), np.zeros((dimension, 0)), np.zeros(0), 0.0)
    _, scatter = _moments(vectors, dimension, known.centred, dimension)
    cov = scatter / n
    values, components = one_sided_jacobi(pivoted_cholesky(cov))
    known = Whitening(n, known.sums, components[:, :most], values[:most], float(np.trace(cov)))
    width = len(known.eigenvalues)
    if not width:
        return known
    first, second = _moments(vectors, dimension, known.whiten, width)
    error = np.abs(second / n - np.outer(first / n, first / n) - np.eye(width)).max()
    return Whitening(n, known.sums, known.components, known.eigenvalues, known.trace, float(error))


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 16) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): one row a vector and component.

    Rows whose vector is null or holds null or non-finite entries are dropped; so are those
    of another length than most (of two lengths with as many rows, the longer one counts).
    Repeated rows are fitted once and returned each. Components without variance have no rows:
    a table whose vectors are all equal, an empty table, or vectors of length 0 give an empty
    result. A null key stays null. Other columns are ignored, whatever their names.
    ``deviation`` is null where a long cannot hold it.
    """
    rows = whole(embeddings.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector")), "vector").select("key", "x")
    schema = f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    length = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    model = None
    if length is not None and length["size"]:
        rows = rows.filter(F.size("x") == length["size"])
        model = fit(rows, most)
    if model is None or not len(model.eigenvalues):
        return embeddings.sparkSession.createDataFrame([], schema)
    dimension, width = model.components.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explained = model.eigenvalues / model.trace
        for batch in batches:
            x, m = matrix(batch.column("x"), dimension), batch.num_rows
            each = pa.array(np.repeat(np.arange(m), width))
            yield pa.record_batch(
                [
                    batch.column("key").take(each),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * width, model.n)),
                    pa.array(model.deviation(x), pa.int64()).take(each),
                    pa.array(model.whiten(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * width, model.identity_error)),
                ],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
