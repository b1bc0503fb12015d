"""Document flattening on hand-written documents."""

import json

import pytest
from conftest import rows

from rankstream import schemas
from rankstream.operators import nested
from rankstream.sources import landing


def participant(puuid, placement, **parts):
    base = {
        "puuid": puuid, "placement": placement, "level": 8, "gold_left": 3,
        "time_eliminated": 1800.5, "total_damage_to_players": 40, "augments": [],
        "traits": [], "units": [], "companion": {"species": "owl"},
    }
    return base | parts


def document(match_id, players, set_name="TFTSet10", game_type="standard"):
    return {
        "metadata": {"match_id": match_id},
        "info": {
            "game_length": 2000.25, "tft_game_type": game_type, "tft_set_core_name": set_name,
            "participants": players,
        },
    }


UNIT = {"character_id": "U1", "tier": 2, "itemNames": ["sword", None, "bow"]}
TRAIT = {"name": "T1", "num_units": 3, "tier_current": 1, "tier_total": 4}
DOCUMENTS = [
    document("m1", [
        participant("a", 1, augments=["x", "y"], units=[UNIT, UNIT], traits=[TRAIT]),
        participant("b", 5, augments=["x", "y", "z", "w"], units=[{"character_id": "U2", "tier": 1}]),
    ]),
    document("m2", []),
    document("m3", [participant("a", 1)], set_name="TFTSet9"),
    document("m4", [participant("a", 1)], game_type="pairs"),
    document("m5", [participant("a", 1, partner_group_id=1), participant("b", 2)]),
]


@pytest.fixture
def documents(spark, tmp_path):
    lines = [json.dumps(d) for d in [*DOCUMENTS, DOCUMENTS[0]]] + ['{"metadata": {broken']
    (tmp_path / "part.json").write_text("\n".join(lines))
    return str(tmp_path)


@pytest.fixture
def silver(spark, documents):
    flat = nested.flatten_documents(landing.read_match_documents(spark, documents))
    return nested.dedupe_matches(flat)


def test_corrupt_line_is_kept_aside(spark, documents):
    raw = landing.read_json(spark, documents, schemas.MATCH_DOCUMENT).cache()
    assert [r[landing.CORRUPT] for r in raw.collect() if r[landing.CORRUPT]] == [
        '{"metadata": {broken'
    ]
    assert landing.read_match_documents(spark, documents).count() == 6


def test_flatten(spark, documents):
    flat = nested.flatten_documents(landing.read_match_documents(spark, documents))
    assert rows(flat, "match_id", "puuid", "outcome") == sorted(
        [("m1", "a", "win"), ("m1", "b", "loss")] * 2 + [("m2", None, "loss")], key=repr
    )


def test_dedupe(silver):
    assert rows(silver, "match_id", "puuid") == [("m1", "a"), ("m1", "b"), ("m2", None)]


def test_augments(silver):
    assert rows(nested.match_augments(silver)) == sorted(
        [("m1", 1, "a", "x", "y", None), ("m1", 5, "b", "x", "y", "z"),
         ("m2", None, None, None, None, None)],
        key=repr,
    )


def test_traits_keep_empty_boards(silver):
    assert rows(nested.match_traits(silver), "match_id", "puuid", "trait_id", "trait_tier") == sorted(
        [("m1", "a", "T1", 1), ("m1", "b", None, None), ("m2", None, None, None)], key=repr
    )


def test_units_drop_itemless_and_keep_null_items(silver):
    found = rows(nested.match_units(silver), "puuid", "unit_id", "item", "pos", "unit_ordinal")
    expected = [
        ("a", "U1", item, pos, ordinal)
        for ordinal in (0, 1)
        for pos, item in enumerate(["sword", None, "bow"])
    ]
    assert found == sorted(expected, key=repr)


def test_summary_has_no_nested_parts(silver):
    assert not {"augments", "units", "traits", "companion"} & set(
        nested.match_summary(silver).columns
    )


def test_catalogue_file(spark, tmp_path):
    path = tmp_path / "champions.json"
    entry = {"id": "c1", "name": "One", "tier": 3, "image": {"full": "c1.png", "x": 1}}
    text = {"type": "champion", "version": "1", "champions": [entry, entry | {"id": "c2"}]}
    path.write_text(json.dumps(text, indent=2))
    found = landing.read_catalogue(spark, str(path), "champions")
    assert rows(found, "id", "tier", "image.full") == [("c1", 3, "c1.png"), ("c2", 3, "c1.png")]


def test_queue_players_ids_are_stable(spark):
    entries = spark.createDataFrame(
        [("a", "RANKED_TFT"), ("a", "RANKED_TFT"), ("b", "OTHER")], "puuid string, queueType string"
    )
    first, second = (rows(landing.queue_players(entries), "idx", "puuid") for _ in range(2))
    assert first == second and len({r[0] for r in first}) == 1
    assert dict(landing.queue_players(entries).dtypes)["processedTime"] == "timestamp"
