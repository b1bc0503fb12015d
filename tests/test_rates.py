"""Rate tables on hand-written rows, and against a plain-Python count."""

from collections import Counter, defaultdict

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankstream.operators import ranking, rates, summaries

TRAITS = "match_id string, puuid string, placement int, trait_id string, trait_tier int"
UNITS = "match_id string, puuid string, placement int, unit_id string, item string, unit_tier int"


def test_trait_base_counts_inactive_rows(spark):
    df = spark.createDataFrame(
        [("m", "a", 1, "T", 1), ("m", "b", 4, "T", 1), ("m", "c", 5, "T", 1), ("m", "d", 1, "T", 0)],
        TRAITS,
    )
    (row,) = rates.trait_metrics(df).collect()
    assert (row.total_matches, row.top_4_matches, row.top_1_matches) == (3, 2, 1)
    assert row.pick_rate == 75.0
    assert round(row.top_4_rate, 6) == 66.666667 and round(row.top_1_rate, 6) == 33.333333


def test_null_match_gives_null_rates_not_an_error(spark):
    df = spark.createDataFrame([(None, "a", 1, "T", 1)], TRAITS)
    (row,) = rates.trait_metrics(df).collect()
    assert row.total_matches == 0 and row.top_4_rate is None


def test_empty_input(spark):
    df = spark.createDataFrame([], TRAITS)
    assert rates.trait_metrics(df).collect() == []


def test_null_item_is_a_group(spark):
    df = spark.createDataFrame([("m", "a", 1, "U", None, 1), ("m", "a", 1, "U", "bow", 1)], UNITS)
    assert rows(rates.item_metrics(df), "item", "pick_rate") == sorted(
        [(None, 50.0), ("bow", 50.0)], key=repr
    )


def test_champion_items_exclude_after_counting_and_break_ties_by_name(spark):
    items = ["g", "f", "e", "d", "c", "b", "a"]
    data = [("m", "p", 1, "U", i, 1) for i in items] + [
        ("m", "p", 1, "U", x, 1) for x in ("X Emblem", "Ornn Hammer", "Radiant Bow", None)
    ]
    found = rates.champion_item_metrics(spark.createDataFrame(data, UNITS))
    assert rows(found, "item") == [(i,) for i in "abcde"]
    assert {r.pick_rate for r in found.collect()} == {9.09}


def test_augments_in_one_pass(spark):
    df = spark.createDataFrame(
        [("m", "a", 1, "x", "y", None), ("m", "b", 8, "x", "x", "z")],
        "match_id string, puuid string, placement int, augment1 string, augment2 string, augment3 string",
    )
    found = rates.augment_metrics(df)
    assert rows(found, "pick_order", "augment_id", "total_matches", "pick_rate") == sorted(
        [(1, "x", 2, 100.0), (2, "x", 1, 50.0), (2, "y", 1, 50.0), (3, None, 1, 50.0), (3, "z", 1, 50.0)],
        key=repr,
    )


def test_placement_level_shares(spark):
    df = spark.createDataFrame(
        [(1, level, 2, 10.0, 5) for level in (4, 6, 7, 9, 10)],
        "placement int, level int, gold_left int, time_eliminated double, total_damage_to_players int",
    )
    (row,) = summaries.placement_metrics(df).collect()
    shares = [row[f"percentage_level_{n}"] for n in ("6_or_less", 7, 8, 9, 10)]
    assert shares == [40.0, 20.0, 0.0, 20.0, 20.0]


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 8, 8, 7])], "id int, v int")
    found = ranking.top_ranked(df, [F.desc("v")], 2)
    assert rows(found, "id", "rank") == [(0, 1), (1, 2), (2, 2)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 8), st.sampled_from("xyz"), st.integers(1, 2)), min_size=1, max_size=40
    )
)
def test_rates_match_a_plain_count(spark, data):
    df = spark.createDataFrame(
        [("m", "p", place, unit, None, tier) for place, unit, tier in data], UNITS
    )
    counts = defaultdict(Counter)
    for place, unit, tier in data:
        counts[unit, tier].update(total=1, top4=place <= 4, top1=place == 1)
    found = rates.champion_metrics(df).collect()
    assert {(r.unit_id, r.unit_tier): (r.total_matches, r.top_4_matches, r.top_1_matches) for r in found} == {
        k: (c["total"], c["top4"], c["top1"]) for k, c in counts.items()
    }
    assert all(0 <= r.top_1_rate <= r.top_4_rate <= 100 for r in found)
    assert abs(sum(r.pick_rate for r in found) - 100) < 0.005 * len(found) + 1e-9
