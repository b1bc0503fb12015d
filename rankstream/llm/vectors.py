"""Rows of embedding vectors, cut to those that hold finite numbers only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream import schemas

LONGS = schemas.array(schemas.LONG)
# Components from here on have no integer of use; they count as infinite.
LARGEST = float(1 << 40)


def usable(vector: Column) -> Column:
    """Not null, not empty, and without null, NaN, infinite or boundless components."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c) < F.lit(LARGEST), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def scaled(vector: Column, scale: int, shift: int = 0) -> Column:
    """floor(scale * c) + shift of each component as long; ``scale`` is a power of two."""
    return F.transform(
        vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(shift)
    )


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """The batch's vectors as one matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def same_width(vectors: DataFrame, order: list, column: str) -> tuple[DataFrame, int]:
    """The rows as long as the first row by ``order``, and that length (0 for no rows)."""
    first = vectors.orderBy(*order).select(F.size(column).alias("n")).first()
    width = first["n"] if first else 0
    return vectors.filter(F.size(column) == width), width


def plain(values: np.ndarray, largest: int) -> np.ndarray:
    """Longs up to ``largest`` as they are, else Python integers, for exact products and sums."""
    if values.size and max(abs(int(values.max())), abs(int(values.min()))) > largest:
        return values.astype(object)
    return values
