"""Placement and player-tier summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankstream.functions.measures import count_where, percent


def placement_metrics(matches: DataFrame, levels: Sequence[int] = (6, 7, 8, 9, 10)) -> DataFrame:
    """Averages per placement and the share of each level in percent.

    The first level stands for "that or less".
    """
    rows = F.count(F.lit(1))
    level = F.col("level")
    lowest, *others = levels
    shares = [
        percent(count_where(level <= lowest), rows).alias(f"percentage_level_{lowest}_or_less")
    ] + [percent(count_where(level == n), rows).alias(f"percentage_level_{n}") for n in others]
    return matches.groupBy("placement").agg(
        F.avg("gold_left").alias("average_gold_left"),
        F.avg("time_eliminated").alias("average_time_eliminated"),
        F.avg("total_damage_to_players").alias("average_damage_to_players"),
        F.avg("level").alias("average_level"),
        *shares,
    )


def player_metrics(players: DataFrame) -> DataFrame:
    """Average wins and losses and the number of players per tier."""
    return players.groupBy("tier").agg(
        F.avg("wins").alias("average_times_won"),
        F.avg("losses").alias("average_times_lost"),
        F.count(F.lit(1)).alias("count"),
    )
