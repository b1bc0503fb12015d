"""Windowed log metrics. Each function takes a batch or a streaming frame of silver logs.

``delay`` adds a watermark: with it the stream can also run in append mode, where closed windows
are written once and their state is dropped. Without it state grows with the number of windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream.functions import requests

TIME = "timestamp"


def _watermarked(logs: DataFrame, delay: str | None) -> DataFrame:
    return logs.withWatermark(TIME, delay) if delay else logs


def _window(length: str) -> Column:
    return F.window(TIME, length)


def _with_day(df: DataFrame, window: str) -> DataFrame:
    return df.withColumn("date", F.date_trunc("day", F.col(f"{window}.start")))


def _is(action: str) -> Column:
    return F.col("action") == action


def window_bounds(df: DataFrame, window: str = "time_window") -> DataFrame:
    """The window struct as flat ``window_start`` and ``window_end``."""
    return df.select(
        F.col(f"{window}.start").alias("window_start"),
        F.col(f"{window}.end").alias("window_end"),
        *[c for c in df.columns if c != window],
    )


def server_metrics(logs: DataFrame, delay: str | None = None) -> DataFrame:
    """Hourly response-time mean and percentiles, request counts and failure share.

    ``server_error_rate`` counts every status from 400 up and is a fraction. The percentiles are exact:
    the least time that at least the share of the hour's times does not pass. An hour holds a count for each
    different whole time, not for each request; :mod:`rankstream.operators.sketches` has the estimates.
    """
    time = F.col("response_time").cast("double")
    requests_made = F.count(F.lit(1))
    failures = F.sum(requests.failed(F.col("status_code")))
    return (
        _watermarked(logs, delay)
        .groupBy(_window("1 hour").alias("time_window"))
        .agg(
            F.avg(time).alias("response_time_mean"),
            *[
                F.expr(f"percentile_disc({p / 100}) WITHIN GROUP (ORDER BY CAST(response_time AS DOUBLE))")
                .alias(f"response_time_{p}p")
                for p in (50, 95, 99)
            ],
            requests_made.alias("request_count"),
            F.sum(requests.succeeded(F.col("status_code"))).alias("successful_request_count"),
            failures.alias("failed_request_count"),
            (failures / requests_made).alias("server_error_rate"),
        )
    )


def transaction_metrics(logs: DataFrame, delay: str | None = None) -> DataFrame:
    """Daily purchases and revenue per product; requests that buy nothing form the null group."""
    bought = _is(requests.TRANSACTION)
    daily = (
        _watermarked(logs, delay)
        .groupBy("product", _window("1 day").alias("time_window"))
        .agg(
            F.sum(F.when(bought, 1).otherwise(0)).alias("transaction_count"),
            F.sum(F.when(bought, F.col("rp"))).alias("total_profit"),
        )
    )
    return _with_day(daily, "time_window")


def engagement_metrics(logs: DataFrame, delay: str | None = None, exact: bool = False) -> DataFrame:
    """Daily distinct users and requests per action; ``exact`` is for batch frames only."""
    users = F.count_distinct("puuid") if exact else F.approx_count_distinct("puuid")
    daily = (
        _watermarked(logs, delay)
        .groupBy("action", _window("1 day").alias("time_window"))
        .agg(users.alias("unique_users_count"), F.count(F.lit(1)).alias("requests_count"))
    )
    return _with_day(daily, "time_window")


def player_activity(logs: DataFrame, delay: str | None = None) -> DataFrame:
    """Daily registrations and game starts, counted as requests."""
    daily = (
        _watermarked(logs, delay)
        .groupBy(_window("1 day").alias("window"))
        .agg(
            F.sum(F.when(_is("register"), 1).otherwise(0)).alias("new_user_count"),
            F.sum(F.when(_is("game-start"), 1).otherwise(0)).alias("active_user_count"),
        )
    )
    return _with_day(daily, "window")


def match_record(matches: DataFrame) -> DataFrame:
    """One row per player: matches played, matches placed and the sum of placements."""
    return matches.groupBy("puuid").agg(
        F.count(F.lit(1)).alias("matches_played"),
        F.count("placement").alias("matches_placed"),
        F.sum("placement").alias("placement_sum"),
    )


def _spread(logs: DataFrame, salts: int) -> DataFrame:
    return logs.withColumn("__salt", F.pmod(F.xxhash64(*logs.columns), F.lit(salts)))


def _copied(rows: DataFrame, salts: int) -> DataFrame:
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    return rows.withColumn("__salt", F.explode(numbers))


def with_match_record(logs: DataFrame, matches: DataFrame, salts: int = 1) -> DataFrame:
    """Log rows joined to their player's match record; players without a match drop out.

    The record has one row per player, so that no log row fans out, and a log row stands for
    ``matches_played`` joined rows. Spark broadcasts the record only if it is small enough.
    Otherwise ``salts > 1`` spreads one player's log rows over that many tasks, which a stream
    needs for hot players; a batch has AQE's skew join.
    """
    record = match_record(matches)
    if salts <= 1:
        return logs.join(record, "puuid")
    return _spread(logs, salts).join(_copied(record, salts), ["puuid", "__salt"]).drop("__salt")


def with_matches(
    logs: DataFrame, matches: DataFrame, columns: Sequence[str] = ("match_id", "placement"), salts: int = 1
) -> DataFrame:
    """A row for each log row and match of its player, with these ``columns`` of the match.

    The result has a player's logs times their matches: where only sums are wanted
    :func:`with_match_record` gives them without it. ``salts`` spreads a hot player's log rows; the
    matches are copied that often, and matches without a player are left out before.
    """
    played = matches.filter(F.col("puuid").isNotNull()).select("puuid", *columns)
    if salts <= 1:
        return logs.join(played, "puuid")
    return _spread(logs, salts).join(_copied(played, salts), ["puuid", "__salt"]).drop("__salt")


def placement_transactions(
    logs: DataFrame,
    matches: DataFrame,
    delay: str | None = "10 minutes",
    recorded: bool = False,
) -> DataFrame:
    """Daily mean placement and purchases per player, over log rows joined to the player's matches.

    Each log row counts once per match of its player. Both sides are summed per player before the
    join, which gives the same numbers without making a row for every log and match. ``recorded``
    says that ``matches`` is a stored :func:`match_record`, which a stream then need not make anew.
    """
    bought = F.when(_is(requests.TRANSACTION), 1).otherwise(0)
    daily = (
        _watermarked(logs, delay)
        .groupBy(_window("1 day").alias("window"), "puuid")
        .agg(F.sum(bought).alias("purchases"))
    )
    joined = daily.join(matches if recorded else match_record(matches), "puuid").select(
        "window",
        "puuid",
        F.try_divide("placement_sum", "matches_placed").alias("average_placement"),
        (F.col("purchases") * F.col("matches_played")).alias("transaction_count"),
    )
    return _with_day(joined, "window")
