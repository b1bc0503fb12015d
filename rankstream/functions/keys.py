"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*columns: str) -> Column:
    """A 64-bit id made from the natural key: the same on every run and every executor."""
    return F.xxhash64(*columns)
