"""Metric tables kept by signed deltas: a delivery's changes are counted, not the whole table.

A change feed holds the rows that a delivery brought (sign +1) and the rows it replaced (sign -1);
:meth:`rankstream.sinks.store.TableStore.upsert` writes it. Every metric here is made of counts and sums,
which add: those of the feed, taken with its sign, bring a table of partial counts up to date, and the
rates and averages are computed from the sums. Groups whose rows are all gone fall out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream.functions.measures import percent
from rankstream.operators import compositions, rates
from rankstream.operators.ranking import top_ranked

SIGN = "__sign"
ROWS = rates.ROWS


def signed(came: DataFrame, went: DataFrame | None = None) -> DataFrame:
    """Rows that came and rows that went as one feed."""
    feed = came.withColumn(SIGN, F.lit(1))
    if went is None:
        return feed
    return feed.unionByName(went.withColumn(SIGN, F.lit(-1)), allowMissingColumns=True)


def net(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial counts added up per key; keys without rows are gone."""
    sums = [c for c in partials.columns if c not in keys]
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).filter(F.col(ROWS) != 0)


@dataclass(frozen=True)
class Metric:
    """A metric table: its keys, the partial counts of a feed, and the table made of their sums."""

    keys: tuple[str, ...]
    partial: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]


def _signed_sum(value: Column) -> Column:
    return F.sum(value * F.col(SIGN))


def _signed_count(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col(SIGN)).otherwise(0))


def rate_metric(keys: Sequence[str], rows_each: int = 1) -> Metric:
    """:func:`rankstream.operators.rates.rate_table` over ``keys``."""

    def finish(counts: DataFrame) -> DataFrame:
        return rates.rates_of(counts, keys, rates.all_rows(counts, keys) / rows_each)

    return Metric(tuple(keys), lambda feed: rates.rate_counts(feed, keys, F.col(SIGN)), finish)


def trait_metric() -> Metric:
    """:func:`rankstream.operators.rates.trait_metrics`."""
    made = rate_metric(["trait_id", "trait_tier"])
    return Metric(made.keys, made.partial, lambda counts: made.finish(counts).filter("trait_tier > 0"))


def champion_item_metric(k: int = 5, excluded: Sequence[str] = rates.SPECIAL_ITEMS) -> Metric:
    """:func:`rankstream.operators.rates.champion_item_metrics`."""
    made = rate_metric(["unit_id", "item"])
    return Metric(
        made.keys, made.partial, lambda counts: rates.best_items(made.finish(counts), k, excluded)
    )


def augment_metric(picks: int = 3) -> Metric:
    """:func:`rankstream.operators.rates.augment_metrics` of a feed of augment columns."""
    made = rate_metric(["pick_order", "augment_id"], picks)

    def partial(feed: DataFrame) -> DataFrame:
        return made.partial(rates.augment_picks(feed, picks, carry=[SIGN]))

    return Metric(made.keys, partial, made.finish)


_AVERAGES = {
    "average_gold_left": "gold_left",
    "average_time_eliminated": "time_eliminated",
    "average_damage_to_players": "total_damage_to_players",
    "average_level": "level",
}


def placement_metric(levels: Sequence[int] = (6, 7, 8, 9, 10)) -> Metric:
    """:func:`rankstream.operators.summaries.placement_metrics`.

    Sums of whole numbers are exact; those of fractions carry their rounding from delta to delta.
    """
    lowest, *others = levels

    def partial(feed: DataFrame) -> DataFrame:
        sums = [x for name, column in _AVERAGES.items() for x in (
            _signed_sum(F.col(column)).alias(f"{name}_sum"),
            _signed_count(F.col(column).isNotNull()).alias(f"{name}_rows"),
        )]
        shares = [_signed_count(F.col("level") <= lowest).alias("level_low")]
        shares += [_signed_count(F.col("level") == n).alias(f"level_{n}") for n in others]
        rows = F.sum(F.col(SIGN)).alias(ROWS)
        return feed.groupBy("placement").agg(rows, *sums, *shares)

    def finish(counts: DataFrame) -> DataFrame:
        rows = F.col(ROWS)
        return counts.select(
            "placement",
            *[F.try_divide(f"{n}_sum", f"{n}_rows").alias(n) for n in _AVERAGES],
            percent(F.col("level_low"), rows).alias(f"percentage_level_{lowest}_or_less"),
            *[percent(F.col(f"level_{n}"), rows).alias(f"percentage_level_{n}") for n in others],
        )

    return Metric(("placement",), partial, finish)


def player_metric() -> Metric:
    """:func:`rankstream.operators.summaries.player_metrics`."""

    def partial(feed: DataFrame) -> DataFrame:
        return feed.groupBy("tier").agg(
            F.sum(F.col(SIGN)).alias(ROWS),
            *[x for c in ("wins", "losses") for x in (
                _signed_sum(F.col(c)).alias(f"{c}_sum"),
                _signed_count(F.col(c).isNotNull()).alias(f"{c}_rows"),
            )],
        )

    def finish(counts: DataFrame) -> DataFrame:
        return counts.select(
            "tier",
            F.try_divide("wins_sum", "wins_rows").alias("average_times_won"),
            F.try_divide("losses_sum", "losses_rows").alias("average_times_lost"),
            F.col(ROWS).alias("count"),
        )

    return Metric(("tier",), partial, finish)


def composition_metric(match_count: Column, k: int = 25, boards: bool = False) -> Metric:
    """:func:`rankstream.operators.compositions.composition_metrics` of a feed of trait rows.

    With ``boards``, of a feed of board rows that hold their traits in an array; a match, player and place
    then has one row per sign.

    A board's rows must come and go together, as they do when its match is delivered again: the
    pairs that went are then those of the old board, the pairs that came those of the new one.
    ``match_count`` is the number of matches in the table after the delivery.
    """

    def finish(counts: DataFrame) -> DataFrame:
        ranked = compositions.strengths_of(counts, match_count)
        return top_ranked(ranked, [F.desc("strength")], k)

    counts = compositions.board_counts if boards else compositions.combination_counts
    return Metric(compositions.COMBINATION, lambda feed: counts(feed, SIGN), finish)
