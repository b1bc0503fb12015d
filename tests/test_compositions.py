"""Trait pairs against brute force, with repeated rows and one hot board."""

from collections import Counter, defaultdict

import pytest
from conftest import rows

from rankstream.operators import compositions

SCHEMA = (
    "match_id string, puuid string, placement int, trait_id string, trait_unit_count int, "
    "trait_tier int, trait_tier_max int"
)

BOARDS = [
    ("m1", "a", 1, "A", 3, 1, 4), ("m1", "a", 1, "B", 2, 2, 3), ("m1", "a", 1, "C", 2, 2, 3),
    ("m1", "a", 1, "Solo", 1, 1, 1), ("m1", "b", 5, "A", 3, 2, 4), ("m1", "b", 5, "B", 2, 1, 3),
    ("m2", "a", 2, "A", 3, 1, 4), ("m2", "a", 2, "B", 2, 2, 3), ("m2", "a", 2, "B", 2, 2, 3),
    ("m2", "a", 2, "A", 3, 3, 4), ("m3", "c", 8, None, None, None, None),
    ("m4", None, 3, "A", 1, 1, 4), ("m4", None, 3, "B", 1, 2, 4),
]


def brute_pairs(board):
    for x in board:
        for y in board:
            if None in x[:6] or None in y[:6]:
                continue
            if x[:3] == y[:3] and x[3] != y[3] and x[5] < y[5] and x[6] > 1 and y[6] > 1:
                yield x, y


def brute_strengths(board):
    matches = len({r[0] for r in board})
    combos = defaultdict(list)
    for x, y in brute_pairs(board):
        combos[x[3], y[3], x[5], y[5], x[6], y[6]].append(x[2])
    strengths = defaultdict(list)
    for (t1, t2, a, b, am, bm), places in combos.items():
        n = len(places)
        top4 = sum(p <= 4 for p in places) / n * 100
        top1 = sum(p == 1 for p in places) / n * 100
        mean = sum(places) / n
        strengths[t1, t2].append(8 / mean * (a / am * b / bm) * (n / matches) * top4 * top1)
    return {k: sum(v) / len(v) for k, v in strengths.items()}


def test_pairs_match_brute_force(spark):
    found = compositions.trait_pairs(spark.createDataFrame(BOARDS, SCHEMA))
    counted = {
        (r.match_id, r.puuid, r.placement, r.trait1, r.trait1_tier, r.trait2, r.trait2_tier): r.pair_count
        for r in found.collect()
    }
    expected = Counter((*x[:3], x[3], x[5], y[3], y[5]) for x, y in brute_pairs(BOARDS))
    assert counted == dict(expected)


@pytest.mark.parametrize("copies", [1, 300])
def test_strengths_match_brute_force(spark, copies):
    """300 copies of a board stand for 90,000 row pairs each, from a handful of joined rows."""
    board = BOARDS + BOARDS[:3] * (copies - 1)
    found = compositions.pair_strengths(spark.createDataFrame(board, SCHEMA))
    expected = brute_strengths(board)
    assert {(r.trait1, r.trait2) for r in found.collect()} == set(expected)
    for r in found.collect():
        assert r.strength == pytest.approx(expected[r.trait1, r.trait2], rel=1e-12)


def test_hot_board_does_not_multiply(spark):
    hot = BOARDS[:3] * 2000 + BOARDS[3:]
    found = compositions.trait_pairs(spark.createDataFrame(hot, SCHEMA)).filter("puuid = 'a' AND match_id = 'm1'")
    assert rows(found, "trait1", "trait2", "pair_count") == [
        ("A", "B", 4_000_000), ("A", "C", 4_000_000)
    ]


def test_ranking_keeps_ties(spark):
    df = spark.createDataFrame(BOARDS, SCHEMA)
    ranks = [r.rank for r in compositions.composition_metrics(df, k=1).collect()]
    assert ranks and set(ranks) == {1}
