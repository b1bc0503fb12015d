"""Trait-pair mining and ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream.functions.measures import percent
from rankstream.operators.ranking import top_ranked
from rankstream.operators.rates import ROWS

BOARD = ("match_id", "puuid", "placement")
TRAIT = ("trait_id", "trait_tier", "trait_tier_max")


def _side(boards: DataFrame, number: int, attributes: Sequence[str], shared: Sequence[str]) -> DataFrame:
    def renamed(name: str) -> str:
        return f"trait{number}" if name == "trait_id" else name.replace("trait", f"trait{number}", 1)

    return boards.select(
        *BOARD,
        *shared,
        *[F.col(a).alias(renamed(a)) for a in attributes],
        F.col("copies").alias(f"copies{number}"),
    )


def _paired(traits: DataFrame, carry: Sequence[str], shared: Sequence[str] = ()) -> DataFrame:
    """Pairs of equal-row groups on one board, with the size of each group.

    ``carry`` are columns of a trait, ``shared`` columns that both of a pair have alike.
    """
    attributes = [*TRAIT, *carry]
    usable = traits.filter(F.col("trait_tier_max") > 1)
    boards = usable.groupBy(*BOARD, *shared, *attributes).agg(F.count(F.lit(1)).alias("copies"))
    low, high = (_side(boards, n, attributes, shared) for n in (1, 2))
    return low.join(high, [*BOARD, *shared]).filter(
        (F.col("trait1_tier") < F.col("trait2_tier")) & (F.col("trait1") != F.col("trait2"))
    )


def trait_pairs(traits: DataFrame, carry: Sequence[str] = ("trait_unit_count",)) -> DataFrame:
    """Pairs of different traits on one board, the lower tier first; equal tiers do not pair.

    Traits with a single tier are left out. Equal rows are first counted together, map-side,
    and a pair carries the product of its two counts in ``pair_count``: the result stands for
    every row pair, yet a board that repeats its rows, however often, yields no more pairs than
    the distinct traits on it. Both join sides read the same shuffle.
    """
    pairs = _paired(traits, carry)
    return pairs.withColumn("pair_count", F.col("copies1") * F.col("copies2")).drop(
        "copies1", "copies2"
    )


def distinct_matches(traits: DataFrame) -> Column:
    """Number of different matches, as a scalar subquery."""
    return traits.select("match_id").distinct().select(F.count(F.lit(1))).scalar()


# What the pairs are counted by.
COMBINATION = (
    "trait1", "trait2", "trait1_tier", "trait2_tier", "trait1_tier_max", "trait2_tier_max",
)


def combination_counts(traits: DataFrame, sign: str | None = None) -> DataFrame:
    """Per combination the additive counts behind the strengths.

    ``sign`` names a column that is +1 for boards that came and -1 for boards that went. The counts
    are doubles: only ratios of them are wanted, and the products may pass the long range.
    """
    shared = [sign] if sign else []
    return _counted(_paired(traits, (), shared), sign)


def board_counts(boards: DataFrame, sign: str | None = None) -> DataFrame:
    """:func:`combination_counts` of boards that hold all their traits in an array, one row a board.

    A board's pairs are made of its own row, so that only the counts are shuffled.
    """
    seats = boards.filter(" AND ".join(f"{c} IS NOT NULL" for c in BOARD))
    usable = F.transform(
        F.filter("traits", lambda t: t.tier_total > 1),
        lambda t: F.struct(
            t["name"].alias("trait"), t.tier_current.alias("tier"), t.tier_total.alias("tier_max")
        ),
    )
    shared = [sign] if sign else []
    rows = seats.select("placement", *shared, usable.alias("rows")).withColumn("kinds", F.array_distinct("rows"))
    counted = F.transform(
        "kinds", lambda k: F.struct(
            k.alias("kind"), F.size(F.filter("rows", lambda t: t.eqNullSafe(k))).alias("copies")
        ),
    )
    boards_ = rows.select("placement", *shared, counted.alias("low"), counted.alias("high"))
    lower = boards_.select("placement", *shared, F.explode("low").alias("low"), "high")
    pairs = lower.select("placement", *shared, "low", F.explode("high").alias("high")).filter(
        "low.kind.tier < high.kind.tier AND low.kind.trait <> high.kind.trait"
    )
    sides = [
        column
        for number, side in ((1, "low"), (2, "high"))
        for column in (
            F.col(f"{side}.kind.trait").alias(f"trait{number}"),
            F.col(f"{side}.kind.tier").alias(f"trait{number}_tier"),
            F.col(f"{side}.kind.tier_max").alias(f"trait{number}_tier_max"),
            F.col(f"{side}.copies").alias(f"copies{number}"),
        )
    ]
    return _counted(pairs.select("placement", *shared, *sides), sign)


def _counted(pairs: DataFrame, sign: str | None) -> DataFrame:
    weight = F.col("copies1").cast("double") * F.col("copies2")
    if sign:
        weight = weight * F.col(sign)
    place = F.col("placement")
    return pairs.groupBy(*COMBINATION).agg(
        F.sum(weight).alias(ROWS),
        F.sum(place * weight).alias("place_sum"),
        F.sum(F.when(place <= 4, weight).otherwise(0)).alias("top_4"),
        F.sum(F.when(place == 1, weight).otherwise(0)).alias("top_1"),
    )


def pair_strengths(traits: DataFrame, match_count: Column | None = None) -> DataFrame:
    """Mean measures per trait pair over its tier combinations.

    Per combination ``strength = 8 / avg_placement * (tier1/max1 * tier2/max2) * pick_rate *
    top_4_rate * top_1_rate`` with ``pick_rate`` a fraction of all matches.
    """
    match_count = distinct_matches(traits) if match_count is None else match_count
    return strengths_of(combination_counts(traits), match_count)


def strengths_of(counts: DataFrame, match_count: Column) -> DataFrame:
    """:func:`pair_strengths` from :func:`combination_counts`."""
    total = F.col(ROWS)
    depth = (F.col("trait1_tier") / F.col("trait1_tier_max")) * (
        F.col("trait2_tier") / F.col("trait2_tier_max")
    )
    rated = counts.select(
        "trait1",
        "trait2",
        F.try_divide("place_sum", total).alias("avg_placement"),
        depth.alias("depth"),
        F.try_divide(total, match_count).alias("pick_rate"),
        percent(F.col("top_4"), total).alias("top_4_rate"),
        percent(F.col("top_1"), total).alias("top_1_rate"),
    )
    strength = (
        F.try_divide(F.lit(8), F.col("avg_placement"))
        * F.col("depth")
        * F.col("pick_rate")
        * F.col("top_4_rate")
        * F.col("top_1_rate")
    )
    means = ["strength", "avg_placement", "pick_rate", "top_4_rate", "top_1_rate"]
    return (
        rated.withColumn("strength", strength)
        .groupBy("trait1", "trait2")
        .agg(*[F.avg(m).alias(m) for m in means])
    )


def composition_metrics(
    traits: DataFrame, k: int = 25, match_count: Column | None = None
) -> DataFrame:
    """The ``k`` strongest trait pairs; ties share a rank, so there may be more than ``k`` rows.

    The final ranking sees one row per trait pair, never match rows.
    """
    return top_ranked(pair_strengths(traits, match_count), [F.desc("strength")], k)
