"""Vector code compression: product quantization with LAESA pivots, in exact integers.

A vector's components become integers, and each of its ``PARTS`` equal parts is replaced by the
number of the nearest entry in that position's codebook. Codebooks are learnt by rounds of
assignment and averaging, starting from the vectors with the smallest ids.

LAESA: each part's distances to a few fixed pivots are computed once and stored with it. A round
computes the distances from pivots to entries, and by the triangle inequality the largest difference
``|d(part, pivot) - d(pivot, entry)|`` is a lower bound of ``d(part, entry)``. Entries are tried in
the order of their bounds, and once the next bound lies above the best distance found the rest is
pruned. Bounds are floating numbers and are lowered by more than their rounding error, distances are
exact integers, so results are those of comparing every entry.

Work: the integers are stored once and read by every round; a task returns one row of sums per
(part, entry), which Spark adds up. The driver holds the codebooks, whose size is fixed by
``PARTS``, ``ENTRIES`` and the vectors' length.

Defined results: vectors that are null, empty, or hold null or non-finite components (from 2^40 on a
component counts as infinite) are dropped; so are vectors of another length than that of the smallest
id, or all if that length is no multiple of ``PARTS``. With fewer vectors than entries the codebooks have as many entries as there are vectors.
Repeated rows count each; ties of an id are ordered by the vector, null ids come last. Integers
beyond 2^26 are compared as Python integers, exactly too; an error beyond a long is null.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm import vectors
from rankstream.llm.common import settle, working

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
PIVOTS = 4
# Components up to this keep squared distances of parts of any usual length within a long.
_PLAIN = 1 << 26
_SLACK = 1e-9  # relative; square roots and sums of longs are far more exact
_STEP = 4096  # rows that are compared at a time

SUMS = schemas.struct(part=schemas.INT, entry=schemas.INT, n=schemas.LONG, sums=vectors.LONGS)
CODED = schemas.struct(
    vec_id=schemas.LONG, label=schemas.STRING, code=schemas.STRING, error=schemas.LONG
)


@dataclass(frozen=True)
class Codebooks:
    """``entries`` by (part, entry, component), ``pivots`` by (part, pivot, component)."""

    entries: np.ndarray
    pivots: np.ndarray

    def digest(self) -> str:
        """Of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows."""
    gap = a - b
    return (gap * gap).sum(axis=-1)


def _exact(values: np.ndarray) -> np.ndarray:
    return vectors.plain(values, _PLAIN)


def choose_pivots(start: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Of one part's first entries some that lie far apart: each the farthest from those before."""
    start = _exact(start)
    chosen = [0]
    away = _squared(start, start[0])
    while len(chosen) < min(pivots, len(start)):
        chosen.append(int(np.argmax(away)))
        away = np.minimum(away, _squared(start, start[chosen[-1]]))
    return start[chosen].astype(np.int64)


def to_pivots(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows of one part to its pivots."""
    parts, pivots = _exact(parts), _exact(pivots)
    squares = np.stack([_squared(parts, p) for p in pivots], axis=1)
    return np.sqrt(squares.astype(np.float64))


def nearest(
    parts: np.ndarray, near: np.ndarray, entries: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest entry, and how many distances were taken.

    ``near`` holds the rows' distances to the pivots. Of entries at one distance the first counts.
    """
    bounds = np.zeros((len(parts), len(entries)))
    away = to_pivots(entries, pivots)
    for at, row in enumerate(away.T):
        np.maximum(bounds, np.abs(near[:, at, None] - row[None, :]), out=bounds)
    error = _SLACK * (near.max(axis=1, initial=0.0)[:, None] + away.max(initial=0.0) + 1.0)
    bounds = np.maximum(bounds - error, 0.0)
    order = np.argsort(bounds, axis=1, kind="stable")
    parts, entries = _exact(parts), _exact(entries)
    wide = object if object in (parts.dtype, entries.dtype) else np.int64
    best = np.full(len(parts), -1, wide)
    which = np.zeros(len(parts), np.int64)
    active, taken = np.arange(len(parts)), 0
    for rank in range(len(entries)):
        tried = order[active, rank]
        if rank:
            bound = bounds[active, tried]
            # an entry whose bound equals the best may tie with it and come first
            open_ = bound * bound <= best[active].astype(np.float64) * (1 + _SLACK)
            active, tried = active[open_], tried[open_]
        if not len(active):
            break
        taken += len(active)
        found = _squared(parts[active], entries[tried])
        known = best[active]
        better = (known < 0) | (found < known) | ((found == known) & (tried < which[active]))
        best[active[better]], which[active[better]] = found[better], tried[better]
    return which, best, taken


def prepared(rows: DataFrame, key: str, vector: str, label: str | None) -> DataFrame:
    """vec_id, label, x of the rows whose vectors are usable, as integers."""
    named = F.col(f"`{label}`").cast("string") if label else F.lit(None).cast("string")
    picked = rows.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), named.alias("label"),
        F.col(f"`{vector}`").alias("v"),
    ).filter(vectors.usable(F.col("v")))
    return picked.select("vec_id", "label", vectors.scaled(F.col("v"), SCALE).alias("x"))


def _by_part(batch: pa.RecordBatch, width: int, pivots: int):
    """(first row, x, pivot distances) of steps of rows, each by (row, part, ...)."""
    x = vectors.matrix(batch.column("x"), width).reshape(-1, PARTS, width // PARTS)
    near = batch.column("near").flatten().to_numpy().reshape(len(x), PARTS, pivots)
    for at in range(0, len(batch), _STEP):
        yield at, x[at : at + _STEP], near[at : at + _STEP]


def _with_pivots(rows: DataFrame, width: int, pivots: np.ndarray) -> DataFrame:
    kind = schemas.struct(
        vec_id=schemas.LONG, label=schemas.STRING, x=vectors.LONGS, near=schemas.array(schemas.DOUBLE)
    )

    def mapped(batches):
        for batch in batches:
            x = vectors.matrix(batch.column("x"), width).reshape(-1, PARTS, width // PARTS)
            near = np.stack([to_pivots(x[:, p], pivots[p]) for p in range(PARTS)], axis=1)
            each = near.shape[1] * near.shape[2]
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * each)
            lists = pa.ListArray.from_arrays(offsets, pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=kind.fieldNames())

    return rows.mapInArrow(mapped, kind)


def _sums(stored: DataFrame, width: int, books: Codebooks) -> DataFrame:
    """(part, entry, at, n, total): what the round adds up for each entry and component."""

    def mapped(batches):
        shape = books.entries.shape
        # Python integers, since no bound on the rows of a task is known
        counts = np.zeros(shape[:2], object)
        totals = np.zeros(shape, object)
        for batch in batches:
            for _, x, near in _by_part(batch, width, books.pivots.shape[1]):
                for p in range(PARTS):
                    which, _, _ = nearest(x[:, p], near[:, p], books.entries[p], books.pivots[p])
                    counts[p] += np.bincount(which, minlength=shape[1])
                    for entry in np.unique(which):
                        totals[p, entry] += _exact(x[which == entry, p]).sum(axis=0)
        used = np.argwhere(counts > 0)
        for p, entry in used.tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), pa.array([entry], pa.int32()),
                 pa.array([int(counts[p, entry])]), pa.array([[int(t) for t in totals[p, entry]]], pa.list_(pa.int64()))],
                names=SUMS.fieldNames(),
            )

    each = stored.select("x", "near").mapInArrow(mapped, SUMS)
    return (
        each.select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
        .groupBy("part", "entry", "at")
        .agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    )


def learn(stored: DataFrame, width: int, books: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks after ``rounds`` of assigning and averaging; unused entries stay."""
    for _ in range(rounds):
        entries = books.entries.copy()
        # one row for each component of the codebooks, whatever the table's size
        for row in _sums(stored, width, books).collect():
            entries[row["part"], row["entry"], row["at"]] = int(row["s"]) // int(row["n"])
        books = Codebooks(entries, books.pivots)
    return books


def encode(stored: DataFrame, width: int, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits per part) and error of every row."""

    def mapped(batches):
        for batch in batches:
            codes, errors = [], []
            for _, x, near in _by_part(batch, width, books.pivots.shape[1]):
                found = [nearest(x[:, p], near[:, p], books.entries[p], books.pivots[p]) for p in range(PARTS)]
                digits = np.stack([which for which, _, _ in found], axis=1).astype(np.uint8)
                codes += [row.tobytes().hex() for row in digits]
                errors += [int(e) for e in sum(best.astype(object) for _, best, _ in found)]
            fits = [e if e < 1 << 63 else None for e in errors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                 pa.array(fits, pa.int64())],
                names=CODED.fieldNames(),
            )

    return stored.mapInArrow(mapped, CODED)


def compressed(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label"
) -> tuple[DataFrame, Codebooks | None]:
    """Each row's code and error (vec_id, label as text, code, error), and the codebooks."""
    spark = rows.sparkSession
    with working(spark) as stage:
        ready = stage(prepared(rows, key, vector, label), "vectors")
        order = [F.asc_nulls_last("vec_id"), "x"]
        ready, width = vectors.same_width(ready, order, "x")
        if not width or width % PARTS:
            return spark.createDataFrame([], CODED), None
        start = np.array([r["x"] for r in ready.orderBy(*order).limit(ENTRIES).collect()], np.int64)
        entries = start.reshape(len(start), PARTS, -1).transpose(1, 0, 2).copy()
        books = Codebooks(entries, np.stack([choose_pivots(part) for part in entries]))
        stored = stage(_with_pivots(ready, width, books.pivots), "pivots")
        books = learn(stored, width, books)
        return settle(encode(stored, width, books), "codes"), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the errors summed over equal labels, nulls together."""
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
