"""The table store: partitions, schema growth, moves and reruns."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

PLAYERS = "puuid string, tier string, wins int"


def test_exact_existence(store, spark, table_name):
    store.append(table_name, spark.createDataFrame([(1,)], "x int"))
    assert store.exists(table_name)
    assert not store.exists(table_name[:-1])


def test_append_adds_columns(store, spark, table_name):
    store.append(table_name, spark.createDataFrame([(1, "p")], "x int, part string"), ["part"])
    store.append(table_name, spark.createDataFrame([("q", 2, 9)], "part string, x int, y int"), ["part"])
    assert rows(store.read(table_name), "x", "y", "part") == [(1, None, "p"), (2, 9, "q")]


def test_overwrite_may_read_itself(store, spark, table_name):
    store.overwrite(table_name, spark.range(3))
    store.overwrite(table_name, store.read(table_name).filter("id > 0"))
    store.overwrite(table_name, store.read(table_name).selectExpr("id", "id * 2 AS twice"))
    assert rows(store.read(table_name)) == [(1, 2), (2, 4)]


@pytest.mark.parametrize("partitioned", [False, True])
def test_upsert_moves_partitions_and_repeats(store, spark, table_name, partitioned):
    by = ["tier"] if partitioned else []
    first = [("a", "GOLD", 1), ("b", "GOLD", 1), ("c", "4-NOT SPECIFIED", 1), ("d", None, 1), (None, "GOLD", 1)]
    store.upsert(table_name, spark.createDataFrame(first, PLAYERS), ["puuid"], partition_by=by)
    update = spark.createDataFrame(
        [("a", "a/b=c:d%", 2), ("c", "GOLD", 2), ("d", "GOLD", 2), (None, None, 2), ("e", "NEW", 2), ("e", "NEW", 1)],
        PLAYERS,
    )
    expected = sorted(
        [("a", "a/b=c:d%", 2), ("b", "GOLD", 1), ("c", "GOLD", 2), ("d", "GOLD", 2), (None, None, 2), ("e", "NEW", 2)],
        key=repr,
    )
    for _ in range(2):
        store.upsert(table_name, update, ["puuid"], [F.desc("wins")], partition_by=by)
        assert rows(store.read(table_name), "puuid", "tier", "wins") == expected


def test_upsert_rewrites_only_touched_partitions(store, spark, table_name):
    data = spark.createDataFrame([("a", "X", 1), ("b", "Y", 1)], PLAYERS)
    store.upsert(table_name, data, ["puuid"], partition_by=["tier"])
    files = {r.tier: r.f for r in store.read(table_name).selectExpr("tier", "_metadata.file_path AS f").collect()}
    store.upsert(table_name, spark.createDataFrame([("a", "X", 2)], PLAYERS), ["puuid"])
    after = {r.tier: r.f for r in store.read(table_name).selectExpr("tier", "_metadata.file_path AS f").collect()}
    assert after["Y"] == files["Y"] and after["X"] != files["X"]


def test_insert_only_upsert_appends(store, spark, table_name):
    store.upsert(table_name, spark.createDataFrame([("a", "X", 1)], PLAYERS), ["puuid"])
    before = {r.f for r in store.read(table_name).selectExpr("_metadata.file_path AS f").collect()}
    store.upsert(table_name, spark.createDataFrame([("b", "X", 1)], PLAYERS), ["puuid"])
    after = {r.f for r in store.read(table_name).selectExpr("_metadata.file_path AS f").collect()}
    assert before < after


def test_unchanged_rows_are_not_rewritten(store, spark, table_name):
    first = spark.createDataFrame([("a", "X", 1), ("b", None, 1)], PLAYERS)
    store.upsert(table_name, first, ["puuid"])
    before = {r.f for r in store.read(table_name).selectExpr("_metadata.file_path AS f").collect()}
    store.upsert(table_name, first.union(spark.createDataFrame([("c", "X", 1)], PLAYERS)), ["puuid"])
    after = {r.f for r in store.read(table_name).selectExpr("_metadata.file_path AS f").collect()}
    assert before < after and store.read(table_name).count() == 3


def test_failed_upsert_raises_and_keeps_the_table(store, spark, table_name):
    store.upsert(table_name, spark.createDataFrame([("a", "X", 1)], PLAYERS), ["puuid"])
    with pytest.raises(Exception):
        store.upsert(table_name, spark.createDataFrame([(1,)], "other int"), ["puuid"])
    assert rows(store.read(table_name)) == [("a", "X", 1)]


def test_partition_filter_prunes(store, spark, table_name):
    data = spark.createDataFrame([("a", "X", 1), ("b", "Y", 1)], PLAYERS)
    store.append(table_name, data, ["tier"])
    picked = store.read(table_name).where("tier = 'X'")
    assert len(picked.inputFiles()) == 1


def test_vacuum_drops_unused_versions_only(store, spark, table_name):
    for n in (1, 2, 3):
        store.overwrite(table_name, spark.range(n))
    assert store.vacuum(table_name) == []
    assert len(store.vacuum(table_name, keep_hours=0)) == 2
    assert store.read(table_name).count() == 3


def test_vacuum_spares_partitions_in_use(store, spark, table_name):
    store.upsert(table_name, spark.createDataFrame([("a", "X", 1), ("b", "Y", 1)], PLAYERS), ["puuid"], partition_by=["tier"])
    for wins in (2, 3):
        store.upsert(table_name, spark.createDataFrame([("a", "X", wins)], PLAYERS), ["puuid"])
    assert store.vacuum(table_name, keep_hours=0) == []
    assert rows(store.read(table_name), "puuid", "wins") == [("a", 3), ("b", 1)]


def _files(store, name):
    return {r.f for r in store.read(name).selectExpr("_metadata.file_path AS f").collect()}


def test_keyed_tables_rewrite_only_the_buckets_of_the_rows(store, spark, table_name):
    many = spark.range(200).selectExpr("concat('p', id) AS puuid", "'X' AS tier", "1 AS wins")
    store.upsert(table_name, many, ["puuid"])
    assert store.partition_columns(table_name) == ["key_bucket"]
    assert store.read(table_name).columns == ["puuid", "tier", "wins"]
    before = _files(store, table_name)
    store.upsert(table_name, spark.createDataFrame([("p7", "Y", 2)], PLAYERS), ["puuid"])
    after = _files(store, table_name)
    folder = {f.rsplit("/", 1)[0] for f in after - before}
    assert len(folder) == 1
    assert {f for f in before if f.rsplit("/", 1)[0] not in folder} < after
    assert rows(store.read(table_name).filter("wins = 2")) == [("p7", "Y", 2)]
    assert store.read(table_name).count() == 200


def test_upsert_scans_only_its_buckets(store, spark, table_name, monkeypatch):
    many = spark.range(200).selectExpr("concat('p', id) AS puuid", "'X' AS tier", "1 AS wins")
    store.upsert(table_name, many, ["puuid"])
    seen = []
    real = type(store)._rows

    def watched(self, name):
        seen.append(real(self, name))
        return seen[-1]

    monkeypatch.setattr(type(store), "_rows", watched)
    update = spark.createDataFrame([("p7", "Y", 2)], PLAYERS)
    with store.staging() as stage:
        store._merge(table_name, update, ["puuid"], stage)
    bucket = real(store, table_name).filter("puuid = 'p7'").first()["key_bucket"]
    pruned = real(store, table_name).filter(f"key_bucket = {bucket}")
    assert len(pruned.inputFiles()) < len(real(store, table_name).inputFiles())


@pytest.mark.parametrize("by", [[], ["tier"]])
def test_a_failed_swap_leaves_the_old_rows(store, spark, table_name, by, monkeypatch):
    first = spark.createDataFrame([("a", "X", 1), ("b", "Y", 1)], PLAYERS)
    update = spark.createDataFrame([("a", "Y", 2), ("c", "Z", 1)], PLAYERS)
    store.upsert(table_name, first, ["puuid"], partition_by=by)
    with monkeypatch.context() as patch:
        patch.setattr(store, "_overwrite_partitions", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.upsert(table_name, update, ["puuid"], partition_by=by)
    assert rows(store.read(table_name), "puuid", "tier", "wins") == [("a", "X", 1), ("b", "Y", 1)]
    store.upsert(table_name, update, ["puuid"], partition_by=by)
    assert rows(store.read(table_name), "puuid", "tier", "wins") == [
        ("a", "Y", 2), ("b", "Y", 1), ("c", "Z", 1)]


def test_partitioned_overwrite_keeps_the_table(store, spark, table_name, monkeypatch):
    store.overwrite(table_name, spark.createDataFrame([("a", "X", 1), ("b", "Y", 1)], PLAYERS), ["tier"])
    half = store.read(table_name).filter("tier = 'Y'").withColumn("wins", F.lit(5))
    with monkeypatch.context() as patch:
        patch.setattr(store, "_overwrite_partitions", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.overwrite(table_name, half, ["tier"])
    assert store.read(table_name).count() == 2
    store.overwrite(table_name, half, ["tier"])
    assert rows(store.read(table_name), "puuid", "tier", "wins") == [("b", "Y", 5)]


def test_no_staging_is_left(store, spark, table_name):
    from rankstream.sinks import folders

    for wins in (1, 2):
        store.upsert(table_name, spark.createDataFrame([("a", "X", wins)], PLAYERS), ["puuid"])
    assert folders.children(spark, f"{store.root}/_staging") == []


def test_prepared_source(store, spark, table_name):
    for wins in (1, 2):
        data = spark.createDataFrame([("a", "X", wins), (None, "Y", wins)], PLAYERS)
        store.upsert(table_name, data, ["puuid"], prepared=True)
    assert rows(store.read(table_name)) == sorted([("a", "X", 2), (None, "Y", 2)], key=repr)


def test_a_forgotten_table_is_not_started_over(store, spark, table_name):
    store.append(table_name, spark.range(1))
    spark.sql(f"DROP TABLE {table_name}")
    with pytest.raises(RuntimeError, match="holds data"):
        store.append(table_name, spark.range(1))


@pytest.mark.parametrize("by", [[], ["tier"]])
def test_create_lost_before_its_rows(store, spark, table_name, by, monkeypatch):
    """A driver lost between naming and filling a table can simply run again."""
    data = spark.createDataFrame([("a", "X", 1)], PLAYERS)
    with monkeypatch.context() as patch:
        patch.setattr(store, "_align", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.upsert(table_name, data, ["puuid"], partition_by=by)
    assert store.read(table_name).count() == 0
    store.upsert(table_name, data, ["puuid"], partition_by=by)
    assert rows(store.read(table_name), "puuid", "tier", "wins") == [("a", "X", 1)]


def scanned(df):
    """Rows and files that the plan's scans read."""
    df.collect()
    plan, found = [df._jdf.queryExecution().executedPlan()], [0, 0]
    while plan:
        node = plan.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            plan.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan"):
            metrics = node.metrics()
            found[0] += metrics.apply("numOutputRows").value()
            found[1] += metrics.apply("numFiles").value()
        children = node.children()
        plan += [children.apply(i) for i in range(children.size())]
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            plan.append(node.plan())
    return tuple(found)


def test_few_keys_open_few_row_groups(store, spark, table_name):
    """The bucket's other files and the row groups without the key are not read."""
    store.buckets = 4
    ids = spark.range(4000).selectExpr("concat('k', xxhash64(id)) AS puuid", "'X' AS tier", "cast(id AS int) AS wins")
    store.upsert(table_name, ids, ["puuid"])
    assert store._bloomed(table_name) == ["puuid"]
    known = ids.filter("wins = 77").select("puuid", "tier", (F.col("wins") + 1).alias("wins"))
    absent = spark.createDataFrame([("k-none", "X", 1)], PLAYERS)
    from rankstream.sinks.store import BUCKET, _bucketed, _in_partitions

    for source, most in ((known, 1100), (absent, 0)):
        placed = _bucketed(source, ["puuid"], 4)
        inside = _in_partitions([BUCKET], placed.select(BUCKET).distinct().collect())
        target = spark.table(table_name).filter(inside).filter(store._few_keys(placed, ["puuid"]))
        read, files = scanned(target)
        assert read <= most and files <= 2
    store.upsert(table_name, known, ["puuid"])
    assert rows(store.read(table_name).filter("wins IN (77, 78)"), "wins") == [(78,), (78,)]


def test_many_keys_are_not_named(store, spark, table_name):
    many = spark.range(100).selectExpr("cast(id AS string) AS puuid", "'X' AS tier", "1 AS wins")
    store.upsert(table_name, many, ["puuid"])
    assert "IN" not in str(store._few_keys(many, ["puuid"])).upper().split("(")[0]
    store.upsert(table_name, many.withColumn("wins", F.lit(2)), ["puuid"])
    assert store.read(table_name).filter("wins = 2").count() == 100


def test_buckets_double_as_they_fill(store, spark, table_name):
    first = spark.range(300).selectExpr("concat('k', id) AS puuid", "'X' AS tier", "0 AS wins")
    store.buckets, store.bucket_bytes = 2, 1 << 30
    store.upsert(table_name, first, ["puuid"])
    assert store._bucket_count(table_name) == 2
    before = rows(store.read(table_name), "puuid", "tier", "wins")
    store.split_buckets(table_name, ["puuid"], 4)
    assert store._bucket_count(table_name) == 4 and store._bloomed(table_name) == ["puuid"]
    assert rows(store.read(table_name), "puuid", "tier", "wins") == before
    assert spark.table(table_name).select("key_bucket").distinct().count() == 4
    from rankstream.sinks import folders

    store.bucket_bytes = folders.size(spark, store._location(table_name)) // 6
    for _ in range(2):
        update = first.filter("puuid LIKE 'k1%'").withColumn("wins", F.lit(5))
        store.upsert(table_name, update, ["puuid"])
    assert store._bucket_count(table_name) >= 8
    assert store.read(table_name).count() == 300
    assert store.read(table_name).filter("wins = 5").count() == update.count()


def test_types_widen_and_old_files_stay(store, spark, table_name):
    store.append(table_name, spark.createDataFrame([(1, 2, 1.5, "a")], "x int, y smallint, z float, part string"), ["part"])
    store.append(table_name, spark.createDataFrame([(2**40, 70000, 1 / 3, "b")], "x bigint, y int, z double, part string"), ["part"])
    store.append(table_name, spark.createDataFrame([(5, 6, 0.5, "a")], "x int, y smallint, z float, part string"), ["part"])
    read = store.read(table_name)
    assert dict(read.dtypes) == {"x": "bigint", "y": "int", "z": "double", "part": "string"}
    assert rows(read, "x", "y", "z") == sorted([(1, 2, 1.5), (2**40, 70000, 1 / 3), (5, 6, 0.5)], key=repr)
    assert read.filter("x = 1 AND part = 'a'").count() == 1


def test_keyed_tables_widen(store, spark, table_name):
    store.upsert(table_name, spark.createDataFrame([("a", "X", 1)], PLAYERS), ["puuid"], delivery="1")
    wide = spark.createDataFrame([("a", "X", 2**40), ("b", "X", 3)], "puuid string, tier string, wins bigint")
    for _ in range(2):
        store.upsert(table_name, wide, ["puuid"], delivery="2")
        assert rows(store.read(table_name), "puuid", "wins") == [("a", 2**40), ("b", 3)]
    assert rows(store.changes(table_name), "puuid", "wins", "__sign") == [
        ("a", 1, -1), ("a", 1, 1), ("a", 2**40, 1), ("b", 3, 1)]
    assert store._bloomed(table_name) == ["puuid"]
    with pytest.raises(Exception):  # nothing holds both: the value does not fit and the cast says so
        store.append(table_name, spark.createDataFrame([("c", "X", 1e300)], "puuid string, tier string, wins double"))


def test_wider_types():
    from rankstream.sinks.store import wider_type

    assert wider_type("int", "bigint") == wider_type("bigint", "int") == "bigint"
    assert wider_type("int", "double") == "double" and wider_type("float", "int") == "double"
    assert wider_type("string", "int") is None and wider_type("bigint", "double") is None


def test_only_changed_windows_are_rewritten(store, spark, table_name, tmp_path):
    """Update mode: the day of an untouched window keeps its file."""
    from rankstream import schemas
    from rankstream.sources.streams import file_stream
    from rankstream.streaming import metrics
    from rankstream.streaming.sinks import update_stream

    def arrive(*stamps):
        data = [("p", f"2024-01-0{d} 10:{m}:00", "POST", 200, 1, 10 * d, f"2024-01-0{d}") for d, m in stamps]
        columns = "puuid string, ts string, request_type string, status_code int, response_size int, response_time int, d string"
        made = spark.createDataFrame(data, columns).selectExpr(
            "puuid", "cast(ts AS timestamp) AS timestamp", "request_type", "status_code", "response_size",
            "response_time", "cast(d AS date) AS date", "cast(NULL AS string) AS product", "cast(NULL AS int) AS rp",
            "'game-start' AS action")
        made.write.mode("append").parquet(str(tmp_path / "in"))
        arrived = file_stream(spark, str(tmp_path / "in"), schemas.SILVER_LOG)
        live = metrics.window_bounds(metrics.server_metrics(arrived)).withColumn("day", F.to_date("window_start"))
        update_stream(live, store, table_name, ["window_start"], str(tmp_path / "check"), ["day"])
        return {str(r.day): r.f for r in store.read(table_name).selectExpr("day", "_metadata.file_path f").collect()}

    first = arrive((1, 10), (1, 20), (2, 10))
    second = arrive((2, 30))
    assert first["2024-01-01"] == second["2024-01-01"] and first["2024-01-02"] != second["2024-01-02"]
    assert rows(store.read(table_name), "request_count") == [(2,), (2,)]


def test_clustered_rows_skip_row_groups(store, spark, table_name):
    """A predicate on two columns reads under a quarter of the rows of the row groups."""
    data = spark.range(40_000).selectExpr(
        "id", "cast(pmod(xxhash64(id), 1000) AS int) AS x", "concat('n', lpad(pmod(xxhash64(id, 1), 1000), 4, '0')) AS y",
        "id % 2 AS part",
    )
    store.append(table_name, data, ["part"])
    before = rows(store.read(table_name), "id", "x", "y", "part")
    from rankstream.sinks import store as module

    held = module._FILE_BYTES
    module._FILE_BYTES = 8_000  # small files stand for the row groups of large ones
    try:
        store.cluster(table_name, ["x", "y"])
    finally:
        module._FILE_BYTES = held
    assert rows(store.read(table_name), "id", "x", "y", "part") == before
    assert store.partition_columns(table_name) == ["part"]
    near = store.read(table_name).filter("x BETWEEN 100 AND 150 AND y BETWEEN 'n0700' AND 'n0750'")
    read, _ = scanned(near)
    assert 0 < read < 40_000 / 4
    assert near.count() == sum(100 <= r[1] <= 150 and "n0700" <= r[2] <= "n0750" for r in before)


def test_z_value_of_columns(spark):
    from rankstream.operators import clustering

    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    got = df.select("a", "b", clustering.z_value([F.col("a"), F.col("b")], 3).alias("z")).collect()
    for r in got:
        assert r.z == int("".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}")), 2)
    odd = spark.createDataFrame([(None, "x"), (1, None), (2, "é")], "n int, s string")
    assert clustering.with_z_value(odd, ["n", "s"]).count() == 3
    assert clustering.with_z_value(odd.limit(0), ["n", "s"]).count() == 0
