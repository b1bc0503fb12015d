"""Top-k selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, tie_break: Sequence[str]
) -> DataFrame:
    """The first ``k`` rows of every group; ``tie_break`` columns make the choice unique.

    Spark keeps at most ``k`` rows per group and task ahead of the shuffle (WindowGroupLimit).
    """
    window = Window.partitionBy(*group).orderBy(*order, *[F.col(c).asc() for c in tie_break])
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.filter(F.col("__rank") <= k).drop("__rank")


def top_ranked(df: DataFrame, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """Rows with rank up to ``k`` over the whole frame; equal rows share a rank and all stay.

    For aggregated frames: each task forwards only its own rows of rank <= k to the last step.
    """
    return df.withColumn(rank, F.rank().over(Window.orderBy(*order))).filter(F.col(rank) <= k)
