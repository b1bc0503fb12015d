"""Aggregate-side expressions shared by the metric tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(predicate: Column) -> Column:
    """How many rows satisfy ``predicate`` (null counts as no)."""
    return F.count_if(predicate)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null, not an error, when ``whole`` is 0."""
    return F.try_divide(part, whole) * 100


def pick_rate(part: Column, base: Column) -> Column:
    """Share of ``base`` in percent, rounded on the fraction to 4 places."""
    return F.round(F.try_divide(part, base), 4) * 100


def finished_top(k: int, placement: str = "placement") -> Column:
    """True for a finish in the first ``k`` places."""
    return F.col(placement) <= k
