"""Rate tables: how often something is picked and how it places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream.functions.measures import finished_top, percent, pick_rate
from rankstream.operators.ranking import top_per_group

# Item-name patterns that mark special items.
SPECIAL_ITEMS = ("%Emblem%", "%Ornn%", "%Radiant%")

COUNTS = ("total_matches", "top_4_matches", "top_1_matches")
RATES = ("pick_rate", "top_4_rate", "top_1_rate")


ROWS = "__rows"


def rate_counts(
    df: DataFrame, keys: Sequence[str], sign: Column | None = None, also: Sequence[Column] = ()
) -> DataFrame:
    """Per key the additive counts behind the rates, combined map-side, and aggregates ``also``.

    ``sign`` weighs each row: +1 for one that came, -1 for one that went. Counts of such changes
    add to those of the rows before (see :mod:`rankstream.operators.deltas`).
    """
    one = F.lit(1) if sign is None else sign

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, one).otherwise(0))

    return df.groupBy(*keys).agg(
        F.sum(one).alias(ROWS),
        rows_where(F.col("match_id").isNotNull()).alias("total_matches"),
        rows_where(finished_top(4)).alias("top_4_matches"),
        rows_where(finished_top(1)).alias("top_1_matches"),
        *also,
    )


def rates_of(counted: DataFrame, keys: Sequence[str], base: Column) -> DataFrame:
    """Counts and rates per key from :func:`rate_counts`; keys without rows are left out."""
    total = F.col("total_matches")
    return counted.filter(F.col(ROWS) != 0).select(
        *keys,
        *COUNTS,
        pick_rate(total, base).alias("pick_rate"),
        percent(F.col("top_4_matches"), total).alias("top_4_rate"),
        percent(F.col("top_1_matches"), total).alias("top_1_rate"),
    )


def all_rows(counted: DataFrame, keys: Sequence[str]) -> Column:
    """The counted rows as a scalar subquery.

    It sums every count, so that its plan holds the same shuffle as the frame it is used in and
    Spark runs that once. Only one row per task reaches the last step.
    """
    sums = [F.sum(c).alias(c) for c in counted.columns if c not in keys]
    return counted.agg(F.struct(*sums).alias("sums")).scalar().getField(ROWS)


def rate_table(
    df: DataFrame, keys: Sequence[str], base: Column | None = None, rows_each: int = 1
) -> DataFrame:
    """Counts and rates per key, in one pass over ``df``.

    ``pick_rate`` is the key's share of ``base``, by default all rows of ``df`` (divided by
    ``rows_each``, where every input row was made into that many). Counting is combined map-side,
    so one key holding a large share of the rows shuffles one row per task.
    """
    counted = rate_counts(df, keys)
    return rates_of(counted, keys, all_rows(counted, keys) / rows_each if base is None else base)


def trait_metrics(traits: DataFrame, base: Column | None = None) -> DataFrame:
    """Rates per trait and reached tier; inactive traits (tier 0) count in the base only."""
    keys = ["trait_id", "trait_tier"]
    if base is not None:
        return rates_of(rate_counts(traits.filter("trait_tier > 0"), keys), keys, base)
    # as an aggregate the tier is compared after the shuffle, which the base then shares
    counted = rate_counts(traits, keys, also=[F.max("trait_tier").alias("__tier")])
    return rates_of(counted.filter("__tier > 0"), keys, all_rows(counted, keys))


def item_metrics(units: DataFrame, base: Column | None = None) -> DataFrame:
    """Rates per item; a null item is a group of its own."""
    return rate_table(units, ["item"], base)


def champion_metrics(units: DataFrame, base: Column | None = None) -> DataFrame:
    """Rates per unit and unit tier, at the grain of the unit's item rows."""
    return rate_table(units, ["unit_id", "unit_tier"], base)


def without_items(df: DataFrame, patterns: Sequence[str] = SPECIAL_ITEMS) -> DataFrame:
    """Rows whose item matches none of the LIKE patterns; null items go too."""
    for pattern in patterns:
        df = df.filter(~F.col("item").like(pattern))
    return df


def champion_item_metrics(
    units: DataFrame,
    k: int = 5,
    excluded: Sequence[str] = SPECIAL_ITEMS,
    base: Column | None = None,
) -> DataFrame:
    """Best ``k`` items per unit by pick rate, then top-four rate, then item name.

    Excluded items are left out of the ranking but stay in the base of the pick rate.
    """
    return best_items(rate_table(units, ["unit_id", "item"], base), k, excluded)


def best_items(rated: DataFrame, k: int = 5, excluded: Sequence[str] = SPECIAL_ITEMS) -> DataFrame:
    """The ranking of :func:`champion_item_metrics` from rates per unit and item."""
    order = [F.desc("pick_rate"), F.desc("top_4_rate")]
    return top_per_group(without_items(rated, excluded), ["unit_id"], order, k, tie_break=["item"])


def augment_picks(augments: DataFrame, picks: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """The augment columns as rows ``(pick_order, augment_id)`` in one pass over the input."""
    slots = F.array(
        *[
            F.struct(F.lit(i).alias("pick_order"), F.col(f"augment{i}").alias("augment_id"))
            for i in range(1, picks + 1)
        ]
    )
    return augments.select("match_id", "placement", "puuid", *carry, F.inline(slots))


def augment_metrics(augments: DataFrame, picks: int = 3, base: Column | None = None) -> DataFrame:
    """Rates per pick position and augment; the base is the rows of one pick."""
    return rate_table(augment_picks(augments, picks), ["pick_order", "augment_id"], base, picks)
