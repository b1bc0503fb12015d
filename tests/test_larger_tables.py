"""Queries over tables with larger keys and groups than the test tables have, and how they spread."""

import duckdb
import pytest

from compare import spark_bag, sql_bag
from pyspark.sql import functions as F

from rankstream.plans import adapters, catalog
from rankstream.plans.catalog import QUERIES
from rankstream.plans.oracle import SQL


def _same_as_sql(spark, folder, name):
    """The query over the folder's tables, each a file or a folder of files, gives its SQL's rows."""
    columns, found = spark_bag(QUERIES[name](spark, str(folder)))
    connection = duckdb.connect()
    for table in folder.glob("*.parquet"):
        files = f"{table}/*.parquet" if table.is_dir() else table
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{files}'")
    assert (columns, found) == sql_bag(connection, SQL[name])


def test_players_past_the_narrow_type_widen(spark, sf_dir, tmp_path):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").limit(300)
    moved = orders.withColumn("o_custkey", F.col("o_custkey") + F.when(F.col("o_custkey") % 3 == 0, 90000).otherwise(0))
    null = orders.limit(2).withColumn("o_custkey", F.lit(None).cast("long"))
    moved.unionByName(null).write.parquet(f"{tmp_path}/orders.parquet")
    _same_as_sql(spark, tmp_path, "widened_types")


@pytest.mark.parametrize("name", ["server_metrics", "stream_server_metrics", "stream_update_server"])
def test_percentiles_of_busy_hours_are_exact(spark, tmp_path, name):
    """60,000 requests with different times in one hour, from several tasks."""
    k = F.pmod(F.xxhash64("id"), F.lit(600000))
    spark.range(0, 60000, 1, 4).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1.7e9) + F.col("id") % 600).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 50).alias("user_id"), F.lit("purchase").alias("event_type"),
        (k / 10 + 0.05).alias("value"), F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    ).coalesce(1).write.parquet(f"{tmp_path}/made")
    (part,) = (tmp_path / "made").glob("*.parquet")
    part.rename(tmp_path / "events.parquet")
    _same_as_sql(spark, tmp_path, name)


def test_a_table_of_200_mb_is_clustered_by_several_tasks(store, spark, table_name, monkeypatch):
    from rankstream.sinks import folders

    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("a"), F.xxhash64("id", "id").alias("b"))
    store.append(table_name, rows)
    monkeypatch.setattr(folders, "size", lambda *_: 200 << 20)
    store.cluster(table_name, ["a", "b"])
    assert len(store.read(table_name).inputFiles()) == 7
    assert store.read(table_name).exceptAll(rows).isEmpty() and store.read(table_name).count() == 20_000


def test_tasks_that_make_documents_grow_with_the_orders(spark, tmp_path):
    many = 50_000 * (spark.sparkContext.defaultParallelism + 4)
    orders = spark.range(many).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus")
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    made = adapters.match_documents(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism + 4


def test_landed_documents_are_packed(spark, sf_dir):
    folder = catalog._landed(spark, sf_dir, spark.range(3), "packed")
    assert all(f.endswith(".json.gz") for f in spark.read.text(folder).inputFiles())
    assert spark.read.schema("id long").json(folder).count() == 3


def test_the_summary_stores_no_nested_columns(spark, sf_dir, monkeypatch):
    made, rows_of = [], catalog._silver_rows
    monkeypatch.setattr(catalog, "_silver_rows", lambda *a: made.append(rows_of(*a)) or made[-1])
    QUERIES["match_summary"](spark, sf_dir)
    assert made and not any(kind.startswith(("array", "struct")) for _, kind in made[0].dtypes)


@pytest.mark.parametrize("name", ["trait_pairs", "composition_metrics"])
def test_tasks_that_make_traits_grow_with_the_lines(spark, tmp_path, name):
    spark.range(40).select(F.col("id").alias("p_partkey"), F.concat(F.lit("B"), F.col("id") % 7).alias("p_brand")).coalesce(
        1).write.parquet(f"{tmp_path}/part.parquet")
    many = 400_000 * (spark.sparkContext.defaultParallelism + 3)
    lines = spark.range(many).select(
        F.expr("id div 4").alias("l_orderkey"), (F.col("id") % 40).alias("l_partkey"), F.lit(1.0).alias("l_quantity"),
        (F.col("id") % 4).cast("int").alias("l_linenumber"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    traits = adapters.match_traits(spark, str(tmp_path))
    assert traits.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism + 3
    plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey#" in plan and f", {spark.sparkContext.defaultParallelism + 3}), REPARTITION_BY_NUM" in plan
