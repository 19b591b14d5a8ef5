"""Whitening of embeddings by their principal components.

The components are the right singular vectors of the centred rows X. Block Golub-Kahan-Lanczos bidiagonalisation finds them
without a covariance matrix: each step multiplies X with a block of right vectors and its transpose with the left vectors that
come of it, both as sums over the rows where they lie. The left vectors are as long as the table, so they are never stored:
each one is X times a short vector of coefficients, and a task makes them anew from its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidelines.llm.vectors import entries, matrix
from sidelines.session import written

SCALE, SHIFT, LARGEST = 1024, 100_000, 2.0 ** 62
# Deviations of less than this part of the largest one can't be told from rounding in double precision.
RANK = 1e-7
CONVERGED = 1e-14
CHUNK = 1 << 20  # entries of a matrix that a task holds as doubles

# (right vectors, coefficients of the left ones so far) -> left' X right, (X right)' X right, sum of squares of X
XV = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, float]]
# (coefficients of new left vectors, of those so far) -> X' new, left' new, new' new
XTU = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Components:
    vectors: np.ndarray  # a column each
    deviations: np.ndarray  # of X along them, times the root of the number of rows
    squares: float  # the sum of squares of X


def bidiagonalised(xv: XV, xtu: XTU, dims: int, wanted: int, block: int = 16, seed: int = 42) -> Components:
    """The ``wanted`` first right singular vectors of a matrix that is known by its products only.

    ``block`` right vectors are advanced at once, which divides the number of products by as many; 1 is the classic method. Left
    and right vectors are orthogonalised against all earlier ones, twice. The block bidiagonal matrix of the products
    grows until the vectors wanted have converged or the right vectors span the whole space; its SVD is small. Where the
    vectors span an invariant space early, random directions go on in the rest.
    """
    random = np.random.default_rng(seed)
    right, left, back = np.empty((dims, 0)), np.empty((dims, 0)), np.empty((dims, 0))  # back: X' times the left vectors
    bidiagonal, before = np.empty((0, 0)), 0
    start = _orthogonal(random.standard_normal((dims, min(block, dims))), right)
    while True:
        first = right.shape[1]
        right = np.hstack([right, start])
        overlap, square, squares = xv(start, left)
        remainder = square - overlap.T @ overlap
        size, axes = np.linalg.eigh((remainder + remainder.T) / 2)
        kept = size > RANK ** 2 * max(np.trace(square), squares / dims)
        inverse = axes[:, kept] / np.sqrt(size[kept])
        new = (start - left @ overlap) @ inverse
        diagonal = np.sqrt(size[kept])[:, None] * axes[:, kept].T
        # a second time, with what the products say of the vectors as they are
        products, overlap2, square2 = xtu(new, left)
        lower = np.linalg.cholesky(square2 - overlap2.T @ overlap2)
        new = np.linalg.solve(lower, (new - left @ overlap2).T).T
        products = np.linalg.solve(lower, (products - back @ overlap2).T).T
        above, diagonal = overlap + overlap2 @ diagonal, lower.T @ diagonal

        grown = np.zeros((left.shape[1] + new.shape[1], right.shape[1]))
        grown[:left.shape[1], :first] = bidiagonal
        grown[before:left.shape[1], first:] = above[before:]
        grown[left.shape[1]:, first:] = diagonal
        bidiagonal, before = grown, left.shape[1]
        left, back = np.hstack([left, new]), np.hstack([back, products])

        u, deviations, v = np.linalg.svd(bidiagonal, full_matrices=False)
        ahead = products - right @ (right.T @ products)
        ahead -= right @ (right.T @ ahead)
        q, size, p = np.linalg.svd(ahead, full_matrices=False)
        top = min(wanted, len(deviations))
        rest = np.linalg.norm(size[:, None] * (p @ u[before:, :top]), axis=0)
        done = block >= wanted and len(deviations) >= wanted and rest.max(initial=0) <= CONVERGED * deviations[0]
        if done or right.shape[1] == dims:
            real = deviations[:top] > RANK * deviations.max(initial=0)
            return Components(right @ v[:top][real].T, deviations[:top][real], squares)
        start = q[:, size > CONVERGED * np.sqrt(squares)]
        missing = min(block, dims - right.shape[1]) - start.shape[1]
        if missing > 0:
            start = np.hstack([start, _orthogonal(random.standard_normal((dims, missing)), np.hstack([right, start]))])


def _orthogonal(vectors: np.ndarray, to: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vectors = np.linalg.qr(vectors - to @ (to.T @ vectors))[0]
    return vectors


def _parts(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(1, CHUNK // dims)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, matrix(part.column("x"), "<i8", dims)


def _totals(table: DataFrame, dims: int) -> tuple[int, list[int], list[int]]:
    """The number of rows; for each dimension the exact sum and the largest distance from zero."""
    def run(batches):
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        most = np.zeros(dims, np.int64)
        for _, x in _parts(batches, dims):
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            most = np.maximum(most, np.abs(x).max(axis=0))
        if n:
            sums = [Decimal(int(h) * 2 ** 32 + int(l)) for h, l in zip(high, low)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()),
                 pa.array(sums, pa.decimal128(38, 0)), pa.array(most)], ["i", "n", "total", "most"])

    parts = table.select("x").mapInArrow(run, "i int, n long, total decimal(38,0), most long")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"),
                                   F.max("most").alias("most")).collect()
    found.sort(key=lambda r: r["i"])
    return found[0]["n"], [int(r["total"]) for r in found], [r["most"] for r in found]


def _deviations(x: np.ndarray, n: int, sums: list[int], small: bool) -> pa.Array:
    """Sums over the dimensions of (n * x - S) ** 2, in whole numbers of any size; ``small`` if 64 bits hold them."""
    if not small:
        away = x.astype(object) * n - np.array(sums, object)
        return pa.array([Decimal(int(d)) for d in (away * away).sum(axis=1)], pa.decimal128(38, 0))
    away = x * n - np.array(sums, np.int64)
    halves = np.zeros((len(x), 2), "<i8")  # a decimal's lower and upper half
    halves[:, 0] = np.einsum("ij,ij->i", away, away)
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(x), [None, pa.py_buffer(halves.tobytes())])


class _Rows:
    """The whole numbers of a table's vectors, ``table(vec_id, x)`` with x as binary, and their products."""

    def __init__(self, table: DataFrame, dims: int):
        self.table, self.dims = table, dims
        self.n, self.sums, largest = _totals(table, dims)
        self.mean = np.array([s / self.n for s in self.sums])
        self.small = dims * max(2 * self.n * m for m in largest) ** 2 < 2 ** 63

    def _summed(self, size: int, of: Callable[[np.ndarray], list[np.ndarray]]) -> np.ndarray:
        """The sum over all rows of what ``of`` gives for some of them, centred."""
        mean, dims = self.mean, self.dims

        def run(batches):
            total, seen = np.zeros(size), False
            for _, x in _parts(batches, dims):
                total += np.concatenate([np.ravel(a) for a in of(x - mean)])
                seen = True
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "value"])

        parts = self.table.select("x").mapInArrow(run, "i int, value double")
        total = np.zeros(size)
        for i, value in parts.groupBy("i").agg(F.sum("value")).collect():
            total[i] = value
        return total

    def xv(self, right: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        both, m, b = np.hstack([left, right]), left.shape[1], right.shape[1]

        def of(x):
            products = x @ both
            return [products.T @ products[:, m:], np.vdot(x, x)]

        found = self._summed((m + b) * b + 1, of)
        products = found[:-1].reshape(m + b, b)
        return products[:m], products[m:], found[-1]

    def xtu(self, new: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        m, r, d = left.shape[1], new.shape[1], self.dims
        if not r:
            return np.empty((d, 0)), np.empty((m, 0)), np.empty((0, 0))

        def of(x):
            vectors = x @ new
            return [x.T @ vectors, (x @ left).T @ vectors, vectors.T @ vectors]

        found = self._summed((d + m + r) * r, of).reshape(-1, r)
        return found[:d], found[d:d + m], found[d + m:]

    def covariance(self, axes: np.ndarray) -> np.ndarray:
        """Of the rows along the axes, centred once more."""
        m = axes.shape[1]

        def of(x):
            w = x @ axes
            return [w.sum(axis=0), w.T @ w]

        found = self._summed(m + m * m, of) / self.n
        return found[m:].reshape(m, m) - np.outer(found[:m], found[:m])

    def whitened(self, axes: np.ndarray) -> DataFrame:
        """``(vec_id, component, deviation, whitened)``, a row for each vector and axis."""
        n, sums, small, mean, dims, m = self.n, self.sums, self.small, self.mean, self.dims, axes.shape[1]

        def run(batches):
            for part, x in _parts(batches, dims):
                rows = pa.array(np.repeat(np.arange(len(x)), m))
                component = np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(rows), pa.array(component), _deviations(x, n, sums, small).take(rows),
                     pa.array(np.ravel((x - mean) @ axes))], ["vec_id", "component", "deviation", "whitened"])

        return self.table.select("vec_id", "x").mapInArrow(
            run, "vec_id long, component int, deviation decimal(38,0), whitened double")


def _whole_numbers(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, dims, x)``: x = floor(1024 * entry) + 100000 of vectors without a null or non-finite entry, as binary."""
    def run(batches):
        for batch in batches:
            good, start, end, flat = entries(batch.column("embedding"))
            x = (np.clip(np.floor(flat * SCALE), -LARGEST, LARGEST).astype("<i8") + SHIFT).tobytes() if len(flat) else b""
            rows = np.nonzero(good)[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), pa.array((end - start)[rows].astype(np.int32)),
                 pa.array([x[8 * start[i]:8 * end[i]] for i in rows], pa.binary())], ["vec_id", "dims", "x"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, dims int, x binary")


def whitened(embeddings: DataFrame, components: int = 8, block: int = 16) -> DataFrame:
    """``embeddings(vec_id, embedding)`` along their principal components, each divided by its deviation.

    A vector that is null, empty or has a null or non-finite entry is left out. The others' entries become whole numbers
    x = floor(1024 * entry) + 100000 (an entry beyond 2 ** 62 / 1024 counts as that); if they differ in length, those of the length that most
    have are taken (of several such lengths the largest). Returns, for each vector left and component up to ``components``: vec_id,
    component, n (vectors left), deviation (sum of (n * x - S) ** 2, a decimal), whitened, explained (the component's part of the
    variance) and identity_error (the covariance of all of whitened, less the identity: the largest entry). Components
    whose deviation is zero (less than 1e-7 of the first one's) can't be whitened and have no rows, so that vectors which are all equal give
    none, like an empty table. Repeated rows and null ids count like any other; other columns are ignored.
    """
    written_rows = written(_whole_numbers(embeddings), "whole-numbers")
    length = written_rows.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if length is not None:
        rows = _Rows(written_rows.filter(F.col("dims") == length["dims"]), length["dims"])
        found = bidiagonalised(rows.xv, rows.xtu, rows.dims, components, block)
        variances = found.deviations ** 2 / rows.n
        axes = found.vectors / np.sqrt(variances)
    if length is None or not len(variances):
        return written_rows.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    error = float(np.abs(rows.covariance(axes) - np.eye(len(variances))).max())
    explained = F.array(*[F.lit(float(v)) for v in variances * rows.n / found.squares])
    return rows.whitened(axes).select(
        "vec_id", "component", F.lit(rows.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("component")).alias("explained"), F.lit(error).alias("identity_error"))
