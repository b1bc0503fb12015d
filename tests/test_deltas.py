"""Metric tables kept by signed deltas against a full recompute."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rankstream.operators import compositions, deltas, nested, rates, summaries
from rankstream.sinks import gold

SEATS = "seat long, match_id string, puuid string, placement int, level int, tier string, " \
    "gold_left int, time_eliminated double, total_damage_to_players int"


def seats(rng, ids):
    return [
        (i, rng.choice([None, f"M{i // 8}"]), f"p{i}", rng.randint(1, 8), rng.choice([None, 5, 6, 8]),
         rng.choice("ABC"), rng.choice([None, 3, 9]), float(rng.randint(1, 9)), i % 5)
        for i in ids
    ]


@pytest.fixture
def names(table_name):
    return table_name, table_name.replace("silver", "gold")


def maintained(spark, store, names, metric, deliveries, schema, keys, feed_of=lambda f: f):
    silver, target = names
    for number, data in enumerate(deliveries):
        store.upsert(silver, spark.createDataFrame(data, schema), keys, delivery=f"d{number}")
        gold.apply_delivery(store, target, metric, feed_of(store.changes(silver, f"d{number}")), f"d{number}")
    return store.read(silver), gold.read_metric(store, target, metric)


@pytest.mark.parametrize("case", ["rates", "placements"])
def test_deliveries_equal_the_recompute(spark, store, names, case):
    rng = random.Random(3)
    deliveries = [seats(rng, range(60)), seats(rng, range(40, 90)), seats(rng, [1, 70, 200]), seats(rng, [1])]
    if case == "rates":
        metric, whole = deltas.rate_metric(["tier", "level"]), lambda df: rates.rate_table(df, ["tier", "level"])
    else:
        metric, whole = deltas.placement_metric(), summaries.placement_metrics
    table, kept = maintained(spark, store, names, metric, deliveries, SEATS, ["seat"])
    assert rows(kept) == rows(whole(table).select(*kept.columns))
    gold.compact(store, names[1], metric, "all")
    assert rows(gold.read_metric(store, names[1], metric)) == rows(kept)


def test_players_and_groups_that_vanish(spark, store, names):
    schema = "puuid string, tier string, wins int, losses int"
    metric = deltas.player_metric()
    table, kept = maintained(spark, store, names, metric, [
        [("a", "X", 1, None), ("b", "X", 3, 4), ("c", "Y", 5, 6)],
        [("c", "X", 5, 6), ("d", None, 1, 1)],
    ], schema, ["puuid"])
    assert rows(kept) == rows(summaries.player_metrics(table))
    assert "Y" not in {r.tier for r in kept.collect()}


def test_augments_and_traits(spark, store, names):
    metric = deltas.augment_metric()
    schema = "match_id string, puuid string, placement int, augment1 string, augment2 string, augment3 string"
    table, kept = maintained(spark, store, names, metric, [
        [("m", "a", 1, "x", "y", None), ("m", "b", 5, "x", "x", "z")], [("m", "a", 2, "x", "w", "z")],
    ], schema, ["match_id", "puuid"])
    assert rows(kept) == rows(rates.augment_metrics(table))
    traits = spark.createDataFrame([("m", 1, "t", 0), ("m", 4, "t", 2), ("n", 1, "s", 2)],
                                   "match_id string, placement int, trait_id string, trait_tier int")
    made = deltas.trait_metric()
    counts = deltas.net(made.partial(deltas.signed(traits)), made.keys)
    assert rows(made.finish(counts)) == rows(rates.trait_metrics(traits))


def test_boards_come_and_go_whole(spark, store, names):
    rng = random.Random(5)

    def boards(ids):
        return [(f"m{i % 4}", f"p{i}", rng.choice([None, 1, 3, 6]),
                 [(f"T{rng.randint(0, 5)}", 2, rng.randint(0, 4), rng.randint(1, 4)) for _ in range(rng.randint(0, 6))])
                for i in ids]

    schema = "match_id string, puuid string, placement int, " \
        "traits array<struct<name string, num_units int, tier_current int, tier_total int>>"
    silver, target = names
    metric = deltas.composition_metric(F.lit(4), k=1000)
    table, kept = maintained(
        spark, store, names, metric, [boards(range(30)), boards(range(20, 40)), boards(range(5))], schema,
        ["match_id", "puuid"], lambda feed: nested.match_traits(feed, carry=[deltas.SIGN]),
    )
    whole = compositions.composition_metrics(nested.match_traits(table), 1000, F.lit(4))
    shape = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                              for r in df.collect())
    assert shape(kept) == shape(whole) and kept.count() > 5


def test_a_repeated_delivery_counts_once_and_keeps_its_feed(spark, store, names, monkeypatch):
    silver, target = names
    metric = deltas.rate_metric(["tier"])
    schema = "id int, match_id string, placement int, tier string"
    first = spark.createDataFrame([(i, "m", i, "X") for i in range(1, 9)], schema)
    second = spark.createDataFrame([(1, "m", 8, "Y"), (2, "m", 2, "X"), (9, "m", 1, "X")], schema)
    store.upsert(silver, first, ["id"], delivery="a")
    gold.apply_delivery(store, target, metric, store.changes(silver, "a"), "a")

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:  # the table is changed in part, the feed is whole
        patch.setattr(store, "_overwrite_partitions", lost)
        patch.setattr(store, "replace_partitions", type(store).replace_partitions.__get__(store))
        with pytest.raises(RuntimeError):
            store.upsert(silver, second, ["id"], delivery="b")
    for _ in range(2):
        store.upsert(silver, second, ["id"], delivery="b")
        feed = store.changes(silver, "b")
        assert rows(feed, "id", "tier", deltas.SIGN) == [(1, "X", -1), (1, "Y", 1), (9, "X", 1)]
        gold.apply_delivery(store, target, metric, feed, "b")
        assert rows(gold.read_metric(store, target, metric)) == rows(rates.rate_table(store.read(silver), ["tier"]))


def test_a_delivery_reads_its_buckets_only(spark, store, names):
    """The table's other buckets are neither read nor rewritten, and gold reads the feed alone."""
    silver, target = names
    metric = deltas.rate_metric(["tier"])
    schema = "id int, match_id string, placement int, tier string"
    store.upsert(silver, spark.createDataFrame([(i, "m", 1, "X") for i in range(400)], schema), ["id"], delivery="a")
    files = {r.key_bucket: r.f for r in spark.table(silver).selectExpr("key_bucket", "_metadata.file_path f").distinct().collect()}
    store.upsert(silver, spark.createDataFrame([(7, "m", 2, "Y")], schema), ["id"], delivery="b")
    after = {r.key_bucket: r.f for r in spark.table(silver).selectExpr("key_bucket", "_metadata.file_path f").distinct().collect()}
    assert len(files) == 16 and sum(files[b] != after[b] for b in files) == 1
    feed = store.changes(silver, "b")
    assert feed.count() == 2
    plan = metric.partial(feed)._jdf.queryExecution().executedPlan().toString()
    assert silver.split(".")[1] + "_changes" in plan and "= b)" in plan.split("PartitionFilters")[1]


def test_boards_count_like_their_rows(spark):
    """Equal rows, null names, tiers and seats, empty and null arrays, both signs."""
    rng = random.Random(9)

    def traits():
        return [(rng.choice(["A", "B", "C", None]), 1, rng.choice([None, 0, 1, 2]), rng.choice([None, 1, 3]))
                for _ in range(rng.randint(0, 9))]

    boards = [(rng.choice([None, f"m{i}"]), f"p{i}", rng.choice([None, 1, 4, 5]), rng.choice([None, traits(), traits()]), s)
              for i in range(300) for s in (1, -1)]
    df = spark.createDataFrame(boards, "match_id string, puuid string, placement int, traits array<struct<"
                               f"name string, num_units int, tier_current int, tier_total int>>, {deltas.SIGN} int")
    found = compositions.board_counts(df, deltas.SIGN)
    wanted = compositions.combination_counts(nested.match_traits(df, carry=[deltas.SIGN]), deltas.SIGN)
    assert found.columns == wanted.columns
    assert rows(found) == rows(wanted) and len(rows(found)) > 10
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Join" not in plan and plan.count("Exchange") == 1
