"""Keyed dedupe, keyed merge and work-queue marking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"


def _tie_breakers(df: DataFrame, used: set[str]) -> list[Column]:
    """The remaining plain columns, then one hash of the nested ones, so that the order is total."""
    rest = [
        f for f in df.schema.fields
        if f.name not in used and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    nested = [F.col(f"`{f.name}`") for f in rest if isinstance(f.dataType, (T.ArrayType, T.StructType))]
    plain = [
        F.col(f"`{f.name}`") for f in rest if not isinstance(f.dataType, (T.ArrayType, T.StructType))
    ]
    return plain + ([F.xxhash64(*nested)] if nested else [])


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the first by ``order``, then by the other columns (nested ones by hash).

    ``row_number() = 1`` lets Spark cut each key to one row per task before the shuffle
    (WindowGroupLimit), so a key holding a large share of the rows costs no more than others.

    ``columns`` narrows the result to the keys and these. Ties are then broken by a hash of the
    whole row, so that the other columns are read but neither sorted nor shuffled.
    """
    if columns is not None:
        hashed = F.xxhash64(*_tie_breakers(df, set()))
        picked = [*keys, *[c for c in columns if c not in keys]]
        named = [o if isinstance(o, str) else None for o in order]
        ordering = [F.col(f"__o{i}") if n else o for i, (o, n) in enumerate(zip(order, named))]
        narrow = df.select(
            *picked,
            *[F.col(n).alias(f"__o{i}") for i, n in enumerate(named) if n],
            hashed.alias("__hash"),
        )
        window = Window.partitionBy(*keys).orderBy(*ordering, "__hash")
        ranked = narrow.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1)
        return ranked.select(*picked)
    given = [F.col(o) if isinstance(o, str) else o for o in order]
    used = {*keys, *(o for o in order if isinstance(o, str))}
    ordering = given + _tie_breakers(df, used)
    window = Window.partitionBy(*keys).orderBy(*(ordering or [F.lit(1)]))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def match_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on every key; still an equi-join to the planner."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after an upsert: matched rows replaced by the source's, the rest inserted.

    ``source`` must hold one row per key (see :func:`first_per_key`). Columns missing on one
    side are filled with null, so the schema may grow.
    """
    incoming = source.select(*keys)
    kept = target.join(incoming, match_on(target, incoming, keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def unprocessed(queue: DataFrame, marker: str = "processedTime") -> DataFrame:
    """Queue entries that carry no processing time yet."""
    return queue.filter(F.col(marker).isNull())


def mark_processed(
    queue: DataFrame,
    processed: DataFrame,
    key: str = "puuid",
    marker: str = "processedTime",
    as_of: Column | None = None,
) -> DataFrame:
    """Stamp the entries whose key is in ``processed`` and that have no stamp yet.

    One join for the whole set; ``as_of`` fixes the stamp for repeatable runs.
    """
    stamp = F.current_timestamp() if as_of is None else as_of
    done = processed.select(key).distinct().withColumn("__done", F.lit(True))
    time = F.coalesce(F.col(marker), F.when(F.col("__done"), stamp))
    return queue.join(done, key, "left").withColumn(marker, time).drop("__done").select(queue.columns)
