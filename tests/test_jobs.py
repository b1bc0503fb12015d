"""All jobs over a small landing folder, twice, with new data in between."""

import json

import pytest
from conftest import rows
from test_nested import TRAIT, UNIT, document, participant

from rankstream import schemas
from rankstream.operators import rates, summaries
from rankstream.plans import jobs
from rankstream.sinks.store import TableStore
from rankstream.sources import records


def catalogue(kind, *entries):
    return json.dumps({"type": kind, "version": "1", kind: list(entries)}, indent=1)


def entry(puuid, tier="GOLD", wins=1, queue="RANKED_TFT"):
    return json.dumps(
        {"puuid": puuid, "summonerId": f"s{puuid}", "queueType": queue, "tier": tier, "rank": "I",
         "wins": wins, "losses": 2, "hotStreak": False}
    )


def log(spark, folder, *found):
    df = spark.createDataFrame(
        [(p, t, "POST", path, status, 10, 50) for p, t, path, status in found], schemas.LOG_RECORD
    )
    records.encode(df).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture(scope="module")
def workspace(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    landing = root / "landing"
    for folder in ("static", "players", "matches"):
        (landing / folder).mkdir(parents=True)
    named = {"id": "i1", "name": "One"}
    (landing / "static/champions.json").write_text(
        catalogue("champions", named | {"tier": 1}, named | {"tier": 1}))
    (landing / "static/traits.json").write_text(catalogue("traits", named))
    (landing / "static/items.json").write_text(catalogue("items", named))
    (landing / "static/augments.json").write_text(
        catalogue("augments", named, {"id": "i2", "name": "One"}))
    (landing / "players/1.json").write_text(
        "\n".join([entry("a"), entry("b"), entry("z", queue="OTHER"), "{broken"]))
    traits = [TRAIT, {"name": "T2", "num_units": 2, "tier_current": 2, "tier_total": 3}]
    seats = [participant("a", 1, augments=["x"], units=[UNIT, UNIT], traits=traits),
             participant("c", 8, traits=traits)]
    (landing / "matches/1.json").write_text(
        "\n".join([json.dumps(document("m1", seats)), json.dumps(document("m0", [])), "{broken"]))
    log(spark, str(landing / "logs"),
        ("a", "2024-01-01T10:00:00+00:00", "/register", 200),
        ("a", "2024-01-01T10:30:00+00:00", "/buy?product=egg&rp=800", 500))
    store = TableStore(spark, str(root / "warehouse"))
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
    made = jobs.Workspace(spark, store, str(landing), publish_to=str(root / "serving"))
    jobs.run(made)
    return made


def test_there_are_21_jobs():
    assert len(jobs.JOBS) == 21


def test_unknown_job(workspace):
    with pytest.raises(KeyError):
        jobs.run(workspace, ["nope"])


def test_static_tables(workspace):
    read = workspace.store.read
    assert rows(read("bronze.champions")) == [("i1", "One", 1)] * 2
    assert rows(read("silver.champions")) == [("i1", "One", 1)]
    assert rows(read("silver.augments"), "name") == [("One",)]


def test_everything_then_again_with_new_data(spark, workspace):
    read = workspace.store.read
    assert rows(read("silver.players"), "puuid", "tier") == [("a", "GOLD"), ("b", "GOLD")]
    done = {p: t is not None for p, t in rows(read("bronze.players"), "puuid", "processedTime")}
    assert done == {"a": True, "b": False}
    assert rows(read("silver.matches"), "match_id", "puuid", "outcome") == [
        ("m0", None, "loss"), ("m1", "a", "win"), ("m1", "c", "loss")]
    assert read("silver.match_units").count() == 6
    assert rows(read("gold.composition_metrics"), "trait1", "trait2", "rank") == [("T1", "T2", 1)]
    assert rows(read("gold.transaction_metrics"), "product", "transaction_count", "total_profit") == sorted(
        [(None, 0, None), ("egg", 1, 800)], key=repr)
    connection = "gold.player_placement_transaction_connection"
    assert read(connection).count() == 0  # the day is not over
    served = spark.read.parquet(f"{workspace.publish_to}/placement_metrics")
    assert served.count() == 3  # the match without participants has no placement

    # a second delivery: m1 again, a new match, a promoted player, a new log
    landing = workspace.landing
    with open(f"{landing}/matches/2.json", "w") as f:
        f.write("\n".join(json.dumps(document(m, [participant("a", 1), participant("b", 2)]))
                          for m in ("m1", "m2")))
    with open(f"{landing}/players/2.json", "w") as f:
        f.write(entry("a", tier="MASTER", wins=9))
    log(spark, f"{landing}/logs", ("b", "2024-01-02T10:00:00+00:00", "/game/start", 200))
    for _ in range(2):  # the repeat finds nothing new and changes nothing
        jobs.run(workspace)
        assert rows(read("silver.matches"), "match_id", "puuid") == [
            ("m0", None), ("m1", "a"), ("m1", "b"), ("m1", "c"), ("m2", "a"), ("m2", "b")]
        assert rows(read("silver.players"), "puuid", "tier", "wins") == [
            ("a", "MASTER", 9), ("b", "GOLD", 1)]
        assert rows(read("gold.player_metrics"), "tier", "count") == [("GOLD", 1), ("MASTER", 1)]
        assert read("silver.logs").count() == 3
        assert sum(r.request_count for r in read("gold.server_metrics").collect()) == 3
        served = spark.read.parquet(f"{workspace.publish_to}/placement_metrics")
        assert served.count() == read("gold.placement_metrics").count()
        closed = rows(read(connection), "puuid", "average_placement", "transaction_count")
        assert closed == [("a", 1.0, 2)]


def test_closed_windows_only(spark, workspace):
    """With a watermark the log metrics hold windows that can no longer change."""
    log(spark, f"{workspace.landing}/logs", ("a", "2024-01-05T10:00:00+00:00", "/game/start", 200))
    names = ["ingest_logs", "preprocess_logs", "server_metrics", "player_activity_metrics", "connection"]
    workspace.late = "10 minutes"
    try:
        for _ in range(2):
            jobs.run(workspace, names)
    finally:
        workspace.late = None
    read = workspace.store.read
    assert rows(read("gold.server_metrics"), "time_window.start", "request_count")[0][1] == 2
    assert sum(r.request_count for r in read("gold.server_metrics").collect()) == 3
    assert sum(r.active_user_count for r in read("gold.player_activity_metrics").collect()) == 1
    connection = read("gold.player_placement_transaction_connection")
    assert rows(connection, "puuid", "transaction_count") == [("a", 2), ("b", 0)]


def test_table_without_rows_can_be_read(spark, workspace, tmp_path):
    bare = spark.createDataFrame([], schemas.BRONZE_LOG)
    bare.write.partitionBy("date").parquet(str(tmp_path / "bare"))
    workspace.show_as("gold.bare", str(tmp_path / "bare"), bare.schema)
    assert workspace.store.read("gold.bare").columns == bare.columns
    assert workspace.store.read("gold.bare").count() == 0


def test_incremental_gold_equals_the_recompute(spark, tmp_path):
    """Deliveries with replaced rows: the kept tables equal those computed from silver."""
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
    (tmp_path / "landing" / "matches").mkdir(parents=True)
    made = jobs.Workspace(
        spark, TableStore(spark, str(tmp_path / "warehouse")), str(tmp_path / "landing"), incremental=True
    )
    names = ["ingest_matches", "preprocess_matches", *jobs._KEPT]
    deliveries = [
        [document("m1", [participant("a", 1, augments=["x"], units=[UNIT]), participant("b", 5)]),
         document("m2", [participant("a", 3, augments=["x", "y"], units=[UNIT, UNIT])])],
        [document("m1", [participant("a", 6, augments=["z"], units=[UNIT]), participant("b", 5)]),
         document("m3", [participant("c", 2, augments=["x"], units=[UNIT])])],
    ]
    sources = {
        "trait_metrics": ("match_traits", rates.trait_metrics), "item_metrics": ("match_units", rates.item_metrics),
        "champion_metrics": ("match_units", rates.champion_metrics),
        "champion_item_metrics": ("match_units", rates.champion_item_metrics),
        "augment_metrics": ("match_augments", rates.augment_metrics),
        "placement_metrics": ("matches", summaries.placement_metrics),
    }
    assert sources.keys() == jobs._KEPT.keys()
    for number, found in enumerate(deliveries):
        (tmp_path / "landing" / "matches" / f"{number}.json").write_text("\n".join(map(json.dumps, found)))
        for _ in range(2):
            jobs.run(made, names)
        for name, (source, metric) in sources.items():
            kept = made.store.read(f"gold.{name}")
            assert rows(kept) == rows(metric(made.store.read(f"silver.{source}")).select(*kept.columns)), name
    assert made.store.changes("silver.matches").filter("__sign < 0").count() == 1
