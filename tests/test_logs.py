"""Record decoding and log functions."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.functions import requests
from rankstream.sources import records
from rankstream.streaming import logs, metrics


def wire(spark, *payloads):
    return spark.createDataFrame([(b"\x00\x00\x00\x00\x07" + p,) for p in payloads], "value binary")


def test_decode_fills_defaults_and_keeps_broken_payloads_as_nulls(spark):
    good = json.dumps({"puuid": "p", "timestamp": "2023-10-01T00:30:00+02:00", "status_code": 200}).encode()
    found = records.decode(wire(spark, good, b"{nope")).collect()
    by_puuid = {r.puuid: r for r in found}
    assert by_puuid["p"].request_type == "NONE" and by_puuid["p"].response_time == 0
    assert all(v is None for v in by_puuid[None])


def test_null_or_short_value(spark):
    df = spark.createDataFrame([(None,), (b"\x00",)], "value binary")
    assert all(v is None for r in records.decode(df).collect() for v in r)


def test_encode_round_trip(spark):
    row = ("p", "2023-10-01T00:30:00+02:00", "POST", "/register", 200, 1, 2)
    df = spark.createDataFrame([row], schemas.LOG_RECORD)
    assert rows(records.decode(records.encode(df))) == [row]


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        records.decode(wire(spark, b""), "xml")


def test_avro_schema_text():
    text = json.loads(schemas.avro_record_schema())
    assert [f["name"] for f in text["fields"]] == schemas.LOG_RECORD.names
    assert {f["type"] for f in text["fields"]} == {"string", "int"}


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/buy?product=egg&rp=800", ("transaction", "egg", 800)),
        ("/buy?rp=2000&product=chibi", ("transaction", "chibi", 2000)),
        ("/buy", ("transaction", None, None)),
        ("/buy?product=x&rp=99999999999", ("transaction", "x", None)),
        ("/register", ("register", None, None)),
        ("/game/start", ("game-start", None, None)),
        ("/game/buy?product=egg&rp=5", ("game-start", "egg", 5)),
        ("/status", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_path_functions(spark, path, expected):
    df = spark.createDataFrame([(path,)], "p string")
    p = F.col("p")
    assert rows(df.select(requests.action(p), requests.product(p), requests.price(p))) == [expected]


def test_date_and_window_agree_across_offsets(spark):
    df = spark.createDataFrame(
        [("p", t, "POST", "/register", 200, 0, 1) for t in ("2023-10-01T00:30:00+02:00", "NONE")],
        schemas.LOG_RECORD,
    )
    bronze = logs.bronze_logs(df)
    dates = [str(r.date) if r.date else None for r in bronze.orderBy("date").collect()]
    assert dates == [None, "2023-09-30"]
    daily = metrics.player_activity(logs.silver_logs(bronze))
    assert [str(r.date)[:10] for r in daily.collect()] == ["2023-09-30"]
    assert bronze.schema == schemas.BRONZE_LOG
    assert [f.name for f in logs.silver_logs(bronze).schema] == schemas.SILVER_LOG.names


def test_status_classes(spark):
    df = spark.createDataFrame([(s,) for s in (101, 200, 204, 301, 404, 500, None)], "s int")
    found = df.select(requests.succeeded(F.col("s")), requests.failed(F.col("s"))).collect()
    assert [tuple(r) for r in found] == [(0, 0), (1, 0), (1, 0), (0, 0), (0, 1), (0, 1), (0, 0)]


def test_placement_join_counts_every_log_and_match(spark):
    """The pre-summed join equals the row-by-row join."""
    logs_df = spark.createDataFrame(
        [("a", "2024-01-01 10:00:00", "transaction"), ("a", "2024-01-01 11:00:00", None),
         ("a", "2024-01-02 11:00:00", "register"), ("b", "2024-01-01 11:00:00", "transaction"),
         (None, "2024-01-01 11:00:00", "transaction")],
        "puuid string, timestamp string, action string",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    matches = spark.createDataFrame(
        [("a", 1), ("a", 2), ("a", None), (None, 4)], "puuid string, placement int"
    )
    found = metrics.placement_transactions(logs_df, matches)
    plain = (
        logs_df.join(matches, "puuid")
        .groupBy(F.window("timestamp", "1 day").alias("window"), "puuid")
        .agg(
            F.avg("placement").alias("average_placement"),
            F.sum(F.when(F.col("action") == "transaction", 1).otherwise(0)).alias("transaction_count"),
        )
    )
    columns = ["window.start", "puuid", "average_placement", "transaction_count"]
    assert rows(found, *columns) == rows(plain, *columns) and found.count() == 2


@pytest.mark.parametrize("salts", [1, 5])
def test_salting_changes_nothing(spark, salts):
    logs_df = spark.range(50).selectExpr(
        "IF(id < 40, 'hot', cast(id AS string)) AS puuid", "timestamp_seconds(id) AS timestamp"
    )
    matches = spark.createDataFrame([("hot", 1), ("hot", 3), ("45", 2)], "puuid string, placement int")
    found = metrics.with_match_record(logs_df, matches, salts)
    assert rows(found.groupBy("puuid", "matches_played", "placement_sum").count()) == [
        ("45", 1, 2, 1), ("hot", 2, 4, 40)
    ]
