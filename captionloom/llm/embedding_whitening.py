"""Whitening of embeddings along their largest principal components, found by LOBPCG.

The covariance is never formed: an iteration multiplies it by a block of vectors in one pass over the centred rows, in
which each task adds up y (y' X) for its rows. Rayleigh and Ritz pick the best block from the span of the iterates, their
residuals and the previous directions. It ends when every residual is certified, by products of this iteration and not by
sums of earlier ones, to be a rounding error of the largest eigenvalue. What the driver holds depends on the dimension alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work

COMPONENTS = 32
#: Vectors iterated beside the components that are asked for; they take the slow convergence upon themselves.
GUARD = 16
SCALE, SHIFT = 64, 1_000_000
#: A residual norm is certified below this share of the largest eigenvalue, which is what double precision can show.
RESIDUAL = 1e-13
MOST_STEPS = 500
#: Eigenvalues below this share of the trace are rounding errors of zero.
NOTHING = 1e-14
#: Rows that are multiplied at a time, and groups of tasks whose sums are added up before the driver adds up the groups.
ROWS, GROUPS = 4096, 16


@dataclass(frozen=True)
class Fit:
    """Number of rows, their exact sums by dimension, eigenvalues and unit eigenvectors (as columns), trace of the covariance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray
    steps: int

    @property
    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and the rest of the division, so that x less the mean loses nothing."""
        whole = self.sums // self.n
        return whole, (self.sums - whole * self.n).astype(float) / self.n


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and x, the shifted whole numbers of the vectors that have no null and no value that is not finite."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("embedding").isNotNull()).select("vec_id", v.alias("v")).where(~bad & (F.size("v") > 0))
    whole = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return rows.select("vec_id", whole.alias("x"))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def added(rows: DataFrame, dimension: int, one: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all rows of one(block of x), added up by task, then by groups of tasks, then on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in parts(batches):
            total += one(matrix(batch.column(0), dimension))
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["s"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(int(np.prod(shape)))
        for batch in batches:
            total += matrix(batch.column(0), total.size).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

    sums = rows.select("x").mapInArrow(run, "s array<double>").repartition(GROUPS).mapInArrow(again, "s array<double>")
    return np.sum([r.s for r in sums.collect()], axis=0).reshape(shape)


def basis(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal columns with the span of the given ones, less what they share."""
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=0), 1e-300)
    u, s, _ = np.linalg.svd(vectors, full_matrices=False)
    return u[:, s > 1e-10 * s[0]]


def lobpcg(product: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int, guard: int = GUARD, tolerance: float = RESIDUAL, most: int = MOST_STEPS):
    """(values, vectors, residual norms, steps) of the largest eigenvalues of a symmetric matrix known by its products."""
    size = min(dimension, wanted + guard)
    x = basis(np.random.default_rng(7).standard_normal((dimension, size)))
    ax, directions = product(x), np.zeros((dimension, 0))
    values, turn = np.linalg.eigh((x.T @ ax + ax.T @ x) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    x, ax = x @ turn, ax @ turn
    for step in range(1, most + 1):
        residual = ax - x * values
        norms = np.linalg.norm(residual, axis=0)
        if (norms[:wanted] <= tolerance * max(values[0], 1e-300)).all():
            return values[:wanted], x[:, :wanted], norms[:wanted], step
        # residuals and directions without what the iterates hold, twice as rounding leaves a rest
        more = np.concatenate([residual, directions], axis=1)
        for _ in range(2):
            more = more - x @ (x.T @ more)
        more = more[:, np.linalg.norm(more, axis=0) > 1e-300]
        more = basis(more) if more.size else more
        whole = np.linalg.qr(np.concatenate([x, more], axis=1))[0]
        whole = whole[:, : min(dimension, whole.shape[1])]
        # one pass over the rows; the iterates' own products are made anew too, so that rounding does not add up
        image = product(whole)
        small = whole.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:size], turn[:, ::-1][:, :size]
        old = whole[:, : x.shape[1]]
        x, ax = whole @ turn, image @ turn
        directions = x - old @ (old.T @ x)
    raise ArithmeticError(f"no certified residuals after {most} steps: {norms[:wanted].max() / values[0]:.1e} of the largest eigenvalue")


def fitted(rows: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> Fit | None:
    """The components of written rows(vec_id, x); None without rows."""
    dimension = rows.select(F.max(F.size("x"))).first()[0]
    if dimension is None:
        return None
    facts = rows.select(F.posexplode("x").alias("k", "c")).groupBy("k").agg(F.sum("c").alias("s"), F.count("c").alias("n")).collect()
    n, sums = facts[0].n, np.array([r.s for r in sorted(facts)], np.int64)
    whole, rest = Fit(n, sums, sums, sums, 0, sums, 0).mean

    def spread(x: np.ndarray) -> np.ndarray:
        return np.array([(((x - whole) - rest) ** 2).sum()])

    trace = float(added(rows, dimension, spread, (1,))[0]) / n
    if trace == 0:
        return Fit(n, sums, np.zeros(0), np.zeros((dimension, 0)), 0.0, np.zeros(0), 0)

    def product(block: np.ndarray) -> np.ndarray:
        def one(x: np.ndarray) -> np.ndarray:
            y = (x - whole) - rest
            return y.T @ (y @ block)

        return added(rows, dimension, one, block.shape) / n

    values, vectors, residuals, steps = lobpcg(product, dimension, min(components, dimension), guard)
    real = values > NOTHING * trace
    return Fit(n, sums, values[real], vectors[:, real], trace, residuals[real], steps)


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, whitened (an array, a value for each component), and of the fit explained (an array) and
    identity_error, for each row of rows(vec_id, embedding) that is usable.

    Rows without a vector, or with a null or an entry that is not finite, are dropped, as are vectors without entries or of
    another length than most have (of equally frequent lengths the larger counts). Repeated rows are fitted and returned as they
    are; ids may be null and repeat. A component without variance cannot be scaled and is left out, so rows that are all equal
    have empty arrays. deviation is exact, and null where it exceeds a long. Other columns are ignored; an empty table gives no
    rows.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    work = Work(rows.sparkSession, "whitening")
    saved = work.save(usable(rows), "whole")
    lengths = saved.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    if len(lengths) > 1:
        saved = saved.where(F.size("x") == lengths[0].d)
    fit = fitted(saved, components)
    if fit is None:
        return rows.sparkSession.createDataFrame([], schema)
    dimension, k = len(fit.sums), len(fit.values)
    whole, rest = fit.mean
    scaled = fit.vectors / np.sqrt(fit.values)

    def white(x: np.ndarray) -> np.ndarray:
        return ((x - whole) - rest) @ scaled

    def outer(x: np.ndarray) -> np.ndarray:
        w = white(x)
        return np.concatenate([w.T @ w, w.sum(axis=0)[None, :]])

    error = 0.0
    if k:
        both = added(saved, dimension, outer, (k + 1, k)) / fit.n
        error = float(np.abs(both[:k] - np.outer(both[k], both[k]) - np.eye(k)).max())
    explained = (fit.values / fit.trace).tolist() if k else []
    n, left = fit.n, (fit.sums - whole * fit.n).astype(np.int64)

    def deviation(x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 in whole numbers: n * (x - whole) - left, of arbitrary size where 64 bits could be too few."""
        near = x - whole
        if dimension * (n * (int(np.abs(near).max(initial=0)) + 1)) ** 2 < 1 << 62:
            return ((n * near - left) ** 2).sum(axis=1).tolist()
        found = ((n * near.astype(object) - left.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            x = matrix(batch.column(1), dimension)
            size = batch.num_rows
            values = pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * k, pa.int32()), pa.array(white(x).ravel()))
            same = pa.array([explained] * size, pa.list_(pa.float64()))
            columns = [batch.column(0), pa.array([n] * size, pa.int64()), pa.array(deviation(x), pa.int64()), values, same, pa.array([error] * size)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return saved.mapInArrow(run, schema)


def whitened_components(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """whitened() with a row for each vector and component (from 1): vec_id, component, n, deviation, whitened, explained,
    identity_error."""
    w = whitened(rows, components)
    w = w.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("k", "value"))
    return w.select("vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", F.col("value").alias("whitened"), F.col("explained")[F.col("k")].alias("explained"), "identity_error")
