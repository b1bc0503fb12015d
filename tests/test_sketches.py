"""Stored sketches and bitmaps: merged summaries against the rows themselves."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rankstream.operators import sketches

LOGS = "timestamp timestamp, action string, puuid string, response_time int"


@pytest.fixture(scope="module")
def logs(spark):
    from datetime import datetime, timedelta

    rng = random.Random(1)
    start = datetime(2024, 1, 1)
    data = [
        (start + timedelta(minutes=rng.randrange(60 * 24 * 9)), rng.choice(["buy", "play", None]),
         f"u{min(rng.randrange(3000), rng.randrange(3000))}", int(rng.paretovariate(1.2) * 10))
        for _ in range(20_000)
    ]
    return spark.createDataFrame(data, LOGS).cache()


def test_days_from_hours_have_the_ranks_of_the_rows(spark, logs, tmp_path):
    sketches.latency_sketches(logs).write.parquet(str(tmp_path / "hours"))
    hours = spark.read.parquet(str(tmp_path / "hours"))
    for unit in ("day", "month"):
        merged = sketches.quantiles(sketches.coarser(hours, unit)).collect()
        direct = {r.start: r for r in sketches.quantiles(sketches.latency_sketches(logs, unit)).collect()}
        times = {}
        for r in logs.select(F.date_trunc(unit, "timestamp").alias("t"), "response_time").collect():
            times.setdefault(r.t, []).append(r.response_time)
        assert {r.start for r in merged} == set(times) == set(direct)
        for r in merged:
            values = times[r.start]
            assert r.requests == len(values) == direct[r.start].requests
            for p in (50, 95, 99):
                for estimate in (r[f"response_time_{p}p"], direct[r.start][f"response_time_{p}p"]):
                    below = sum(v < estimate for v in values) / len(values)
                    upto = sum(v <= estimate for v in values) / len(values)
                    assert below <= p / 100 + 3 * sketches.RANK_ERROR
                    assert upto >= p / 100 - 3 * sketches.RANK_ERROR


def exact_weeks(logs):
    found = {}
    for r in logs.select("action", F.date_trunc("day", "timestamp").cast("date").alias("d"), "puuid").collect():
        from datetime import timedelta

        for ahead in range(7):
            found.setdefault((r.action, r.d + timedelta(days=ahead)), set()).add(r.puuid)
    return {k: len(v) for k, v in found.items()}


def test_weekly_users(spark, logs, tmp_path):
    want = exact_weeks(logs)
    logs.select("puuid").distinct().write.parquet(str(tmp_path / "ids"))
    numbers = sketches.numbered(spark.read.parquet(str(tmp_path / "ids")), after=9)
    n = [r.number for r in numbers.collect()]
    assert sorted(n) == list(range(10, 10 + len(n)))
    exact = sketches.exact_users_in_last_days(sketches.user_bitmaps(logs, numbers))
    assert {(r.action, r.day): r.users for r in exact.collect()} == want
    guess = sketches.users_in_last_days(sketches.user_sketches(logs)).collect()
    assert {(r.action, r.day) for r in guess} == set(want)
    for r in guess:
        assert abs(r.users - want[r.action, r.day]) <= max(1, 3 * sketches.USERS_ERROR * want[r.action, r.day])


def test_empty(spark):
    none = spark.createDataFrame([], LOGS)
    assert rows(sketches.quantiles(sketches.coarser(sketches.latency_sketches(none), "day"))) == []
    assert rows(sketches.users_in_last_days(sketches.user_sketches(none))) == []
