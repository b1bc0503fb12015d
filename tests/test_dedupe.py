"""Dedupe, merge and queue marking."""

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankstream.operators import dedupe

KV = "k int, v int"
ANY = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
PAIRS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9)), max_size=12)


def last_wins(data):
    merged = {}
    for k, v in data:
        merged[k] = max(v, merged.get(k, v))
    return merged


def test_first_per_key_is_total(spark):
    df = spark.createDataFrame([(1, 2, ["b"]), (1, 2, ["a"]), (2, 1, None)], "k int, v int, xs array<string>")
    for parts in (1, 3):
        found = dedupe.first_per_key(df.repartition(parts), ["k"], [F.desc("v")])
        assert rows(found) == [(1, 2, ["a"]), (2, 1, None)]


def test_narrow_first_per_key_takes_values_of_one_row(spark):
    df = spark.createDataFrame(
        [(1, 2, "p", ["b"]), (1, 2, "q", ["a"]), (1, 1, "z", None), (2, 1, None, None), (2, 1, None, None)],
        "k int, v int, w string, xs array<string>",
    )
    found = [rows(dedupe.first_per_key(df.repartition(n), ["k"], [F.desc("v")], ["w", "v"])) for n in (1, 3)]
    assert found[0] == found[1] and found[0][0][0] == 1 and found[0][0][1] in "pq" and len(found[0]) == 2
    named = dedupe.first_per_key(df, ["k"], ["v"], ["w"])
    assert named.columns == ["k", "w"] and rows(named)[0] == (1, "z")


@ANY
@given(PAIRS, PAIRS)
def test_merge_properties(spark, old, new):
    target = dedupe.first_per_key(spark.createDataFrame(old, KV), ["k"], [F.desc("v")])
    source = dedupe.first_per_key(spark.createDataFrame(new, KV), ["k"], [F.desc("v")])
    once = dedupe.merge_rows(target, source, ["k"])
    expected = sorted((last_wins(old) | last_wins(new)).items(), key=repr)
    assert rows(once) == expected
    assert rows(dedupe.merge_rows(once, source, ["k"])) == expected


def test_merge_grows_the_schema(spark):
    target = spark.createDataFrame([(1, 1)], KV)
    source = spark.createDataFrame([(2, 2, "n")], "k int, v int, extra string")
    assert rows(dedupe.merge_rows(target, source, ["k"])) == [(1, 1, None), (2, 2, "n")]


def test_mark_processed(spark):
    queue = spark.createDataFrame(
        [("a", None), ("a", None), ("b", None), ("c", "2020-01-01 00:00:00")],
        "puuid string, processedTime string",
    ).withColumn("processedTime", F.col("processedTime").cast("timestamp"))
    done = spark.createDataFrame([("a",), ("c",), ("c",), ("z",)], "puuid string")
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    marked = dedupe.mark_processed(queue, done, as_of=stamp)
    years = [(p, t and t.year) for p, t in rows(marked)]
    assert years == [("a", 2024), ("a", 2024), ("b", None), ("c", 2020)]
    assert rows(dedupe.unprocessed(marked), "puuid") == [("b",)]
