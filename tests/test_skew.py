"""A third of all rows on one key: results stay whole, and no step sees the key's raw rows at once."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rankstream.operators import compositions, dedupe, rates
from rankstream.streaming import metrics

N = 300_000
HOT = N // 3


@pytest.fixture(scope="module")
def skewed(spark):
    """Ids 0..N-1, every third on the key ``hot``."""
    hot = F.col("id") % 3 == 0
    return spark.range(N).withColumn(
        "puuid", F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 5000))
    )


def test_rates(skewed):
    df = skewed.selectExpr(
        "puuid AS item", "'m' AS match_id", "cast(id % 8 + 1 AS int) AS placement"
    )
    hot = rates.item_metrics(df).filter("item = 'hot'").first()
    assert (hot.total_matches, hot.pick_rate) == (HOT, 33.33)
    assert hot.top_4_matches == HOT // 2


def test_dedupe_shuffles_one_hot_row_per_task(skewed):
    first = dedupe.first_per_key(skewed, ["puuid"], [F.desc("id")])
    assert rows(first.filter("puuid = 'hot'")) == [(N - 3, "hot")]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_merge(spark, skewed):
    source = spark.createDataFrame([(-1, "hot"), (-2, "new")], "id long, puuid string")
    merged = dedupe.merge_rows(skewed, source, ["puuid"])
    assert merged.count() == N - HOT + 2


def test_logs_and_matches_of_one_player(skewed):
    """100,000 log rows by 100,000 matches: ten billion joined rows, summed without making them."""
    logs = skewed.selectExpr(
        "puuid", "timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id % 1440, 0) AS timestamp",
        "IF(id % 2 = 0, 'transaction', null) AS action",
    )
    matches = skewed.selectExpr("puuid", "cast(id % 8 + 1 AS int) AS placement")
    (hot,) = metrics.placement_transactions(logs, matches).filter("puuid = 'hot'").collect()
    assert hot.transaction_count == HOT // 2 * HOT
    assert hot.average_placement == pytest.approx(4.5)


def test_one_board_repeated(spark):
    board = spark.range(N).selectExpr(
        "IF(id % 3 = 0, 'hot', 'm' || id % 9000) AS match_id", "'p' AS puuid", "1 AS placement",
        "'T' || (id DIV 3) % 4 AS trait_id", "1 AS trait_unit_count",
        "cast((id DIV 3) % 4 AS int) AS trait_tier", "4 AS trait_tier_max",
    )
    pairs = compositions.trait_pairs(board).filter("match_id = 'hot'")
    found = rows(pairs, "trait1", "trait2", "pair_count")
    each = HOT // 4
    assert found == [(f"T{a}", f"T{b}", each * each) for a in range(4) for b in range(a + 1, 4)]
