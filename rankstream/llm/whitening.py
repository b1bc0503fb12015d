"""Embedding whitening: leading principal components by spectrum slicing.

Components are eigenvectors of the covariance of all different vectors, after rounding to integers.
Sums and products are taken in exact integers around the rounded mean, so the covariance has no
rounding error but that of its last step. Its size is the square of the vectors' length, and it is
the only thing the driver holds.

Spectrum slicing: the factorization ``L D L^T`` of the covariance less a shift has as many positive
pivots as there are eigenvalues above the shift (Sylvester). Bisection on these counts isolates the
leading eigenvalues one by one; in each interval Rayleigh quotient iteration converges cubically; and
counts just above and below the value found prove its number. Eigenvalues that no shift can tell
apart in double precision are found together by inverse iteration on a subspace.

Work: the different vectors are stored once and read for the mean, the products, and the check of the
whitened covariance; a task returns one partial sum for each entry, which Spark adds up.

Defined results: vectors that are null, empty, or hold null or non-finite components (from 2^40 on a
component counts as infinite) are dropped, as are vectors of another length than that of the smallest
id (null ids last). Components whose eigenvalue is zero within rounding are left out, so one vector,
or copies of one, give no rows. Repeated rows get rows each. A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm import vectors
from rankstream.llm.common import settle, working

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
_STEP = 2048  # rows that are multiplied at a time
_EPS = float(np.finfo(float).eps)
# Bunch and Parlett's bound between pivots of one and of two rows.
_ALPHA = (1 + 17**0.5) / 8

PARTIAL = schemas.struct(at=schemas.INT, total=schemas.STRING)
WHITE = schemas.struct(
    vec_id=schemas.LONG, component=schemas.INT, n=schemas.LONG, deviation=schemas.LONG,
    whitened=schemas.DOUBLE, explained=schemas.DOUBLE,
)


# -- spectrum slicing of a small symmetric matrix ------------------------------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed ``shift``: positive pivots of ``L D L^T``.

    Pivots are chosen from the whole rest (Bunch and Parlett); one of two rows has one positive
    and one negative eigenvalue.
    """
    rest = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(rest):
        diagonal = np.abs(np.diag(rest))
        r = int(np.argmax(diagonal))
        most = int(np.argmax(np.abs(rest)))
        p, q = divmod(most, len(rest))
        if diagonal[r] >= _ALPHA * abs(rest[p, q]):
            pivot = rest[r, r]
            if pivot == 0:  # nothing but zeros is left: none above
                break
            positive += pivot > 0
            column = np.delete(rest[:, r], r)
            rest = np.delete(np.delete(rest, r, 0), r, 1) - np.outer(column, column / pivot)
        else:
            positive += 1
            block = rest[np.ix_([p, q], [p, q])]
            columns = np.delete(rest[:, [p, q]], [p, q], 0)
            rest = np.delete(np.delete(rest, [p, q], 0), [p, q], 1) - columns @ np.linalg.solve(block, columns.T)
    return int(positive)


def _solved(matrix: np.ndarray, shift: float, right: np.ndarray, size: float) -> np.ndarray:
    """(matrix - shift)^-1 right; a singular matrix is moved by its rounding error."""
    for more in (0.0, _EPS * size, 16 * _EPS * size):
        try:
            found = np.linalg.solve(matrix - (shift + more) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found
    raise ArithmeticError("no shift makes the matrix regular")


def rayleigh(matrix: np.ndarray, shift: float, start: np.ndarray, size: float) -> tuple[float, np.ndarray]:
    """Eigenvalue and unit eigenvector that the iteration from ``shift`` and ``start`` reaches."""
    v, value, least = start / np.linalg.norm(start), shift, np.inf
    best = (shift, v)
    for _ in range(30):
        v = _solved(matrix, value, v, size)
        v /= np.linalg.norm(v)
        value = float(v @ matrix @ v)
        residual = float(np.linalg.norm(matrix @ v - value * v))
        if residual >= least / 2 and least <= 64 * _EPS * size:
            break
        if residual < least:
            least, best = residual, (value, v)
    return best


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` positive eigenvalues, falling, and their eigenvectors as columns."""
    d = len(matrix)
    size = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    close = 8 * d * _EPS * size  # counts are certain to this distance
    random = np.random.default_rng(7)
    known = {size + close: 0}  # shifts and their counts
    values: list[float] = []
    columns: list[np.ndarray] = []

    def count(shift: float) -> int:
        if shift not in known:
            known[shift] = above(matrix, shift)
        return known[shift]

    positive = count(close) if size > 0 else 0
    while len(values) < min(wanted, positive):
        number = len(values)  # eigenvalues found, all above those to come
        high = min(s for s, c in known.items() if c <= number)
        low = max(s for s, c in known.items() if c > number)
        while True:
            inside = count(low) - count(high)
            if inside == 1:
                value, vector = rayleigh(matrix, (low + high) / 2, random.standard_normal(d), size)
                # certified: exactly the next eigenvalue lies within the counts' certainty
                if low < value <= high and count(value - close) > number >= count(value + close):
                    found = [(value, vector)]
                    break
            if high - low <= 4 * close:
                basis = np.linalg.qr(random.standard_normal((d, inside)))[0]
                for _ in range(4):
                    basis = np.linalg.qr(_solved(matrix, (low + high) / 2, basis, size))[0]
                found = [(float(v @ matrix @ v), v) for v in basis.T]
                break
            middle = (low + high) / 2
            if count(middle) > number:
                low = middle
            else:
                high = middle
        for value, vector in sorted(found, key=lambda f: -f[0]):
            for other in columns:
                vector = vector - (other @ vector) * other
            vector = vector / np.linalg.norm(vector)
            columns.append(vector * np.sign(vector[np.argmax(np.abs(vector))]))
            values.append(value)
    kept = min(wanted, len(values))
    if not kept:
        return np.empty(0), np.empty((d, 0))
    return np.array(values[:kept]), np.stack(columns[:kept], axis=1)


# -- sums over the table -------------------------------------------------------------------


def _added(fit: DataFrame, width: int, sums_of: Callable[[np.ndarray], np.ndarray]) -> list:
    """Sum over all rows of the arrays that ``sums_of`` gives for steps of rows.

    Integers pass as text and are added as decimals, exactly; floating numbers as doubles.
    """

    def mapped(batches):
        total, bound = None, 0
        for batch in batches:
            x = vectors.matrix(batch.column("x"), width)
            for at in range(0, len(x), _STEP):
                part = sums_of(x[at : at + _STEP])
                if part.dtype == np.int64:
                    bound += int(np.abs(part).max(initial=0))
                    if bound >= 1 << 62:  # Python integers from here on
                        part = part.astype(object)
                total = part if total is None else total + part
        numbers = [] if total is None else total.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(numbers)), pa.int32()), pa.array(map(repr, numbers), pa.string())],
            names=PARTIAL.fieldNames(),
        )

    partial = fit.select("x").mapInArrow(mapped, PARTIAL)
    whole = ~F.col("total").rlike("[.en]")
    rows = partial.groupBy("at").agg(
        F.sum(F.when(whole, F.col("total").cast("decimal(38,0)"))).alias("whole"),
        F.sum(F.when(~whole, F.col("total").cast("double"))).alias("real"),
    )
    # a row for each entry, as many as the vectors' length allows
    found = sorted(rows.collect(), key=lambda r: r["at"])
    return [r["real"] if r["whole"] is None else int(r["whole"]) for r in found]


@dataclass(frozen=True)
class Whitener:
    """What turns integers ``x`` into whitened components; plain arrays, sent to the tasks."""

    n: int
    sums: list[int]
    values: np.ndarray
    columns: np.ndarray
    trace: float

    @property
    def centre(self) -> list[int]:
        """The rounded mean."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centre = self.centre
        rest = np.array([(s - self.n * c) / self.n for s, c in zip(self.sums, centre)])
        centred = (x - np.array(centre, np.int64)).astype(float) - rest
        return centred @ self.columns / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2 of each row, exactly."""
        centre = self.centre
        rest = np.array([s - self.n * c for s, c in zip(self.sums, centre)], object)
        near = x - np.array(centre, np.int64)
        largest = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if largest * largest * max(1, len(centre)) < 1 << 62:
            gaps = self.n * near - rest.astype(np.int64)
        else:
            gaps = self.n * near.astype(object) - rest
        return [int(v) for v in (gaps * gaps).sum(axis=1)]


def fit_whitener(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitener | None:
    """From the table of different vectors ``x``; None if there are none."""

    def sums(x: np.ndarray) -> np.ndarray:
        return np.append(vectors.plain(x, (1 << 62) // _STEP).sum(axis=0), len(x))

    total = _added(fit, width, sums)
    if not total:
        return None
    n = total.pop()
    base = Whitener(n, total, np.empty(0), np.empty((width, 0)), 0.0)
    centre = np.array(base.centre, np.int64)

    lower = np.tril_indices(width)

    def products(x: np.ndarray) -> np.ndarray:
        near = vectors.plain(x - centre, 1 << 20)
        if near.dtype == object:
            return (near.T @ near)[lower]
        near = near.astype(float)  # products of 2 * 20 bits, summed over 2^11 rows: exact
        return (near.T @ near)[lower].astype(np.int64)

    rest = [s - n * c for s, c in zip(base.sums, base.centre)]
    covariance = np.empty((width, width))
    for i, j, product in zip(*lower, _added(fit, width, products)):
        covariance[i, j] = covariance[j, i] = (n * product - rest[i] * rest[j]) / (n * n)
    values, columns = leading(covariance, components)
    return Whitener(n, base.sums, values, columns, float(np.trace(covariance)))


def identity_error(fit: DataFrame, width: int, made: Whitener) -> float:
    """Largest entry of the whitened covariance less the identity, measured over the table."""
    k = len(made.values)

    def products(x: np.ndarray) -> np.ndarray:
        white = made.whitened(x)
        return np.append((white.T @ white).ravel(), white.sum(axis=0))

    total = np.array(_added(fit, width, products)) / made.n
    square, mean = total[: k * k].reshape(k, k), total[k * k :]
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def _applied(rows: DataFrame, width: int, made: Whitener) -> DataFrame:
    explained = made.values / made.trace
    k = len(made.values)

    def mapped(batches):
        for batch in batches:
            whole = vectors.matrix(batch.column("x"), width)
            for at in range(0, len(whole), _STEP):
                x = whole[at : at + _STEP]
                deviation = [v if v < 1 << 63 else None for v in made.deviations(x)]
                rows_of = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(at, _STEP).take(rows_of),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(k * len(x), made.n)),
                     pa.array(deviation, pa.int64()).take(rows_of),
                     pa.array(made.whitened(x).ravel()),
                     pa.array(np.tile(explained, len(x)))],
                    names=WHITE.fieldNames(),
                )

    return rows.select("vec_id", "x").mapInArrow(mapped, WHITE)


def whitened(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per component."""
    spark = rows.sparkSession
    result = schemas.struct(**{f.name: f.dataType for f in WHITE.fields}, identity_error=schemas.DOUBLE)
    with working(spark) as stage:
        picked = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
        ready = stage(
            picked.filter(vectors.usable(F.col("v")))
            .select("vec_id", vectors.scaled(F.col("v"), SCALE, SHIFT).alias("x")),
            "vectors",
        )
        ready, width = vectors.same_width(ready, [F.asc_nulls_last("vec_id"), "x"], "x")
        fit = stage(ready.select("x").distinct(), "fit")
        made = fit_whitener(fit, width, components) if width else None
        if made is None or not len(made.values):
            return spark.createDataFrame([], result)
        error = identity_error(fit, width, made)
        return settle(_applied(ready, width, made).withColumn("identity_error", F.lit(error)), "white")
