"""Stored summaries of log rows that merge: from hours to days and months without the logs.

Quantiles are KLL sketches, approximate distinct counts HLL sketches, exact distinct counts bitmaps over
dense numbers. Each is one aggregate over the rows, combined map-side, and a small row per group; wider
ranges are unions of those rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIME = "timestamp"
# Items kept per KLL level, and the normalized rank error stated for that size.
KLL_ITEMS, RANK_ERROR = 400, 0.0068
# Registers of an HLL sketch as a power of two, and the relative standard error of that size.
HLL_BITS, USERS_ERROR = 12, 1.04 / (1 << 12) ** 0.5


# -- quantiles -----------------------------------------------------------------------------


def latency_sketches(logs: DataFrame, unit: str = "hour") -> DataFrame:
    """(start, requests, sketch) of the response times per hour, or another unit of time."""
    return logs.groupBy(F.date_trunc(unit, TIME).alias("start")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.kll_sketch_agg_bigint(F.col("response_time").cast("long"), F.lit(KLL_ITEMS)).alias("sketch"),
    )


def coarser(sketches: DataFrame, unit: str) -> DataFrame:
    """The same for a longer unit, from the stored sketches alone."""
    return sketches.groupBy(F.date_trunc(unit, "start").alias("start")).agg(
        F.sum("requests").alias("requests"),
        F.kll_merge_agg_bigint("sketch", F.lit(KLL_ITEMS)).alias("sketch"),
    )


def quantiles(sketches: DataFrame, ranks: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """start, requests and a column ``response_time_<p>p`` per rank."""
    return sketches.select(
        "start", "requests",
        *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(r)).alias(f"response_time_{round(100 * r)}p")
          for r in ranks],
    )


# -- distinct users ------------------------------------------------------------------------


def _day() -> Column:
    return F.date_trunc("day", TIME).cast("date")


def _last_days(summaries: DataFrame, days: int) -> DataFrame:
    """Each day's rows under every day whose last ``days`` days include it."""
    ends = F.sequence(F.col("day"), F.date_add("day", days - 1))
    return summaries.withColumn("day", F.explode(ends))


def user_sketches(logs: DataFrame) -> DataFrame:
    """(action, day, requests, sketch): an HLL sketch of the day's users of each action."""
    return logs.groupBy("action", _day().alias("day")).agg(
        F.count(F.lit(1)).alias("requests"), F.hll_sketch_agg("puuid", HLL_BITS).alias("sketch")
    )


def users_in_last_days(sketches: DataFrame, days: int = 7) -> DataFrame:
    """(action, day, requests, users): estimates over the ``days`` days up to each day."""
    return _last_days(sketches, days).groupBy("action", "day").agg(
        F.sum("requests").alias("requests"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"),
    )


def numbered(ids: DataFrame, after: int = -1) -> DataFrame:
    """``ids`` with ``number``: dense numbers from ``after + 1`` on.

    ``ids`` must be stored, so that its partitions are the same each time. Numbers are a count of the
    partitions before and a place within, so no row passes through one task.
    """
    place = F.monotonically_increasing_id()
    placed = ids.select("*", F.shiftright(place, 33).alias("__part"), place.bitwiseAND((1 << 33) - 1).alias("__at"))
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the input
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    number = F.col("__before") + F.col("__at") + F.lit(after + 1)
    return placed.join(starts, "__part").withColumn("number", number).drop("__part", "__at", "__before")


def user_bitmaps(logs: DataFrame, numbers: DataFrame) -> DataFrame:
    """(action, day, bucket, users): the day's users as bits at their numbers.

    ``numbers`` (puuid, number) are dense, so a bucket's 32,768 bits stand for as many users.
    """
    rows = logs.select("action", _day().alias("day"), "puuid").join(numbers, "puuid")
    return rows.groupBy("action", "day", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    )


def exact_users_in_last_days(bitmaps: DataFrame, days: int = 7) -> DataFrame:
    """(action, day, users): exact distinct counts over the ``days`` days up to each day."""
    merged = _last_days(bitmaps, days).groupBy("action", "day", "bucket").agg(
        F.bitmap_or_agg("users").alias("users")
    )
    return merged.groupBy("action", "day").agg(F.sum(F.bitmap_count("users")).alias("users"))
