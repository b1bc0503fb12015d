"""Rows in Z-order: one sort key that keeps rows near in several columns together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Z_VALUE = "__z"


def _number(name: str, kind: T.DataType) -> Column:
    """An order-keeping number of the value; texts by their first six bytes."""
    value = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(value, "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    return value.cast("double")


def range_bounds(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list[float]]:
    """Per column the bounds of ``2 ** bits`` ranges of about equal numbers of rows, in one pass."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    found = df.agg(
        *[F.percentile_approx(_number(c, kinds[c]), shares, 1000).alias(c) for c in columns]
    ).first()  # one row
    return {c: sorted(set(found[c] or [])) for c in columns}


def z_value(ranges: Sequence[Column], bits: int) -> Column:
    """The bits of the columns' range numbers in turn, highest first, as one number."""
    value = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for number in ranges:
            one = F.shiftright(number, bit).bitwiseAND(1).cast("long")
            value = F.shiftleft(value, 1).bitwiseOR(one)
    return value


def with_z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> DataFrame:
    """``df`` with :data:`Z_VALUE`; nulls lie in the first range of their column."""
    bounds = range_bounds(df, columns, bits)
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def number(name: str) -> Column:
        at = F.array(*[F.lit(b) for b in bounds[name]]).cast("array<double>")
        place = _number(name, kinds[name])
        return F.size(F.filter(at, lambda bound: bound <= place))

    return df.withColumn(Z_VALUE, z_value([number(c) for c in columns], bits))
