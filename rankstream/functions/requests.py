"""Expressions over one server-log record; the same in batch and stream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path fragment -> action name, tested in this order.
ACTIONS = (
    ("game", "game-start"),
    ("register", "register"),
    ("buy", "transaction"),
)
TRANSACTION = "transaction"


def event_time(timestamp: Column) -> Column:
    """ISO-8601 text with offset to an instant; unreadable text becomes null."""
    return F.try_to_timestamp(timestamp)


def event_date(instant: Column) -> Column:
    """UTC calendar date of the instant, so it agrees with the time windows."""
    return F.to_date(instant)


def action(path: Column) -> Column:
    """First action whose fragment occurs in the path, else null."""
    label = F.lit(None).cast("string")
    for fragment, name in reversed(ACTIONS):
        label = F.when(path.contains(fragment), F.lit(name)).otherwise(label)
    return label


def _query_value(path: Column, name: str, pattern: str) -> Column:
    found = F.regexp_extract(path, rf"[?&]{name}=({pattern})", 1)
    return F.when(path.contains("buy") & (found != ""), found)


def product(path: Column) -> Column:
    """Product named in a purchase path, else null."""
    return _query_value(path, "product", "[^&]*")


def price(path: Column) -> Column:
    """Price in a purchase path as an integer, else null."""
    return _query_value(path, "rp", "[0-9]+").try_cast("int")


def succeeded(status: Column) -> Column:
    """1 for a 2xx status, else 0."""
    return F.when(status.between(200, 299), 1).otherwise(0)


def failed(status: Column) -> Column:
    """1 for any status from 400 up, else 0; 1xx and 3xx are neither success nor failure."""
    return F.when(status >= 400, 1).otherwise(0)
