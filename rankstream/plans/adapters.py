"""Match, player and log frames derived from the star-schema test tables.

All derivations are row-local except the trait boards (one join to ``part`` and one combined
aggregate), so that they add as little as possible to the plans under test:

* eight consecutive order keys are one match, an order is one seat in it, its place is the
  position in the eight, and the player is the customer, whose keys cover the events' users
* a line item is an item on a unit (the part's brand) and counts toward the brand's trait; the
  board it lies on is named by its order
* events are server requests
* match documents and league entries are built from the columns of one order or customer each
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankstream import schemas
from rankstream.sources.streams import file_stream
from rankstream.streaming import logs as log_rows

SEATS = 8
# Orders of which one task makes the match documents.
ORDERS_A_TASK = 50_000
# Line items of which one task makes the traits.
LINES_A_TASK = 400_000
PRODUCTS = ("battle-pass", "chibi", "egg", "tactician")
# LIKE patterns that stand in for the special items in the test data
EXCLUDED_ITEMS = ("%widget%", "%plate%", "%ring%")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seat(key: str, player: str) -> list[Column]:
    return [
        F.expr(f"{key} div {SEATS}").cast("string").alias("match_id"),
        F.col(player).cast("string").alias("puuid"),
        (F.col(key) % SEATS + 1).cast("int").alias("placement"),
    ]


def matches(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    key, price = F.col("o_orderkey"), F.floor("o_totalprice")
    place = F.col("placement")
    return (
        table(spark, sf_dir, "orders")
        .select(
            *_seat("o_orderkey", "o_custkey"),
            (F.lit(3) + key % 8).cast("int").alias("level"),
            (price % 60).cast("int").alias("gold_left"),
            F.date_diff(F.to_date("o_orderdate"), F.lit("1992-01-01").cast("date")).cast("double")
            .alias("time_eliminated"),
            (price % 150).cast("int").alias("total_damage_to_players"),
            F.col("o_orderpriority").alias("tier"),
            *extra,
        )
        .withColumn("outcome", F.when(place < 5, F.lit("win")).otherwise(F.lit("loss")))
    )


def _two_deliveries(rows: DataFrame, key: Column, change: Callable[[DataFrame], DataFrame]):
    """Rows with keys off the fives; then those on the threes, changed: some replace, some are new."""
    return rows.filter(key % 5 != 0), change(rows.filter(key % 3 == 0))


def match_deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Seats keyed by ``seat``; the second delivery turns their places and raises their levels."""
    seat = F.col("seat")
    rows = matches(spark, sf_dir, F.col("o_orderkey").alias("seat"))
    return _two_deliveries(rows, seat, lambda df: df.withColumns(
        {"placement": F.lit(SEATS + 1) - F.col("placement"), "level": F.col("level") + 1}
    ))


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boards with their traits as an array."""
    trait = F.struct(
        F.col("trait_id").alias("name"), F.col("trait_unit_count").cast("int").alias("num_units"),
        F.col("trait_tier").alias("tier_current"), F.col("trait_tier_max").alias("tier_total"),
    )
    return match_traits(spark, sf_dir).groupBy("match_id", "puuid", "placement").agg(
        F.array_sort(F.collect_list(trait)).alias("traits")
    )


def board_deliveries(boards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`boards` in two deliveries; the second one moves every trait's tier."""

    def moved(df: DataFrame) -> DataFrame:
        raised = F.transform(
            "traits", lambda t: t.withField("tier_current", ((t.tier_current + 1) % 5).cast("int"))
        )
        return df.withColumn("traits", raised)

    return _two_deliveries(boards, F.col("puuid").cast("long"), moved)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def match_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.least(F.lit(4), F.floor((F.col("quantity") - 1) / 20))
    # grouping reduces the lines little, so its hash tables grow with a task's lines: these do not grow
    # with the table, as parts that adaptive execution merges by their packed size would
    lines = _lines(spark, sf_dir).select("l_orderkey", "p_brand", "l_quantity")
    count = table(spark, sf_dir, "lineitem").count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-count // LINES_A_TASK))
    return (
        lines.repartition(tasks, "l_orderkey")
        .groupBy("l_orderkey", "p_brand")
        .agg(F.count(F.lit(1)).alias("trait_unit_count"), F.sum("l_quantity").alias("quantity"))
        .select(
            *_seat("l_orderkey", "l_orderkey"),
            F.col("p_brand").alias("trait_id"),
            "trait_unit_count",
            tier.cast("int").alias("trait_tier"),
            F.lit(4).alias("trait_tier_max"),
        )
    )


def match_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        *_seat("l_orderkey", "l_orderkey"),
        F.col("p_brand").alias("unit_id"),
        F.col("p_name").alias("item"),
        (F.col("p_size") % 3 + 1).alias("unit_tier"),
        (F.col("l_linenumber") - 1).alias("pos"),
    )


def match_augments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order's part names by line number; the greatest name where a number repeats."""
    picked = [
        F.max(F.when(F.col("l_linenumber") == i, F.col("p_name"))).alias(f"augment{i}")
        for i in (1, 2, 3)
    ]
    return (
        _lines(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(*picked)
        .select(*_seat("l_orderkey", "l_orderkey"), "augment1", "augment2", "augment3")
    )


# -- players -------------------------------------------------------------------------------


def league_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """League entries of the customers; customers of every fourth nation come in twice."""
    key = F.col("c_custkey")
    copies = F.when(F.col("c_nationkey") % 4 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return (
        table(spark, sf_dir, "customer")
        .withColumn("copy", F.explode(copies))
        .select(
            F.concat(F.lit("P"), key).alias("puuid"),
            F.concat(F.lit("S"), key).alias("summonerId"),
            F.when(key % 5 == 0, F.lit("RANKED_TFT_TURBO")).otherwise(F.lit("RANKED_TFT"))
            .alias("queueType"),
            F.col("c_mktsegment").alias("tier"),
            F.element_at(F.array(*map(F.lit, ("I", "II", "III", "IV"))), (key % 4 + 1).cast("int"))
            .alias("rank"),
            (key % 50 + F.col("copy")).cast("int").alias("wins"),
            (key % 40).cast("int").alias("losses"),
            (key % 3 == 0).alias("hotStreak"),
        )
    )


def processed_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players whose matches have arrived: twice the customer of every order, with repeats."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.concat(F.lit("P"), F.col("o_custkey") * 2).alias("puuid"))


# -- catalogue -----------------------------------------------------------------------------


def catalogue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line JSON texts, each a list of at most 200 champion documents, one per part.

    A document has one to three entries. ``file`` numbers the texts.
    """
    key, entry = F.col("p_partkey"), F.sequence(F.lit(1), F.lit(3))
    champions = F.transform(
        F.slice(entry, 1, (key % 3 + 1).cast("int")),
        lambda i: F.struct(
            F.concat(F.lit("C"), key, F.lit("_"), i).alias("id"),
            F.col("p_name").alias("name"),
            ((key + i) % 5 + 1).cast("int").alias("tier"),
        ),
    )
    document = F.struct(
        F.col("p_type").alias("type"), F.lit("1").alias("version"), champions.alias("champions")
    )
    parts = table(spark, sf_dir, "part").select(
        F.expr("p_partkey div 200").alias("file"), document.alias("document")
    )
    listed = parts.groupBy("file").agg(F.collect_list("document").alias("documents"))
    return listed.select("file", F.to_json("documents", {"pretty": "true"}).alias("text"))


# -- match documents -----------------------------------------------------------------------


def _first(n: Column, limit: int) -> Column:
    """1..n as an array, n at most ``limit``; empty for 0."""
    return F.slice(F.sequence(F.lit(1), F.lit(limit)), 1, n.cast("int"))


def _id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number)


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One match document per order, finished orders delivered twice.

    Covers empty participant lists, empty and null arrays, null elements, partner games, other
    sets and other game types.
    """
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def trait(i: Column, j: Column) -> Column:
        return F.struct(
            _id("T", (c + i + j * 5) % 29).alias("name"),
            (F.lit(1) + (k + j) % 9).cast("int").alias("num_units"),
            ((k + i + j) % 5).cast("int").alias("tier_current"),
            (F.lit(1) + (c + j) % 4).cast("int").alias("tier_total"),
        )

    def unit(i: Column, j: Column) -> Column:
        items = F.transform(
            _first((k + j) % 4, 3),
            lambda m: F.when((k + j + m) % 11 != 0, _id("I", (c + j + m) % 50)),
        )
        return F.struct(
            _id("U", (c + i + j * 3) % 60).alias("character_id"),
            (F.lit(1) + (k + j) % 3).cast("int").alias("tier"),
            F.when((k + j) % 7 != 0, items).alias("itemNames"),
        )

    def participant(i: Column) -> Column:
        return F.struct(
            _id("P", c * SEATS + i).alias("puuid"),
            i.cast("int").alias("placement"),
            (F.lit(3) + (k + i) % 8).cast("int").alias("level"),
            ((k * i) % 60).cast("int").alias("gold_left"),
            (F.lit(1000) + (k * 3 + i * 17) % 1200).cast("double").alias("time_eliminated"),
            ((k + i * i) % 150).cast("int").alias("total_damage_to_players"),
            F.when(k % 17 == 0, F.floor((i + 1) / 2).cast("int")).alias("partner_group_id"),
            F.transform(_first((k + i) % 4, 3), lambda j: _id("A", (c + i + j) % 40))
            .alias("augments"),
            F.transform(_first((k + i * 2) % 6, 5), lambda j: trait(i, j)).alias("traits"),
            F.transform(_first((k + i) % 5, 4), lambda j: unit(i, j)).alias("units"),
        )

    document = F.struct(
        F.struct(_id("M", k).alias("match_id")).alias("metadata"),
        F.struct(
            (F.lit(1200) + k % 900).cast("double").alias("game_length"),
            F.when(k % 13 == 0, F.lit("pairs")).otherwise(F.lit("standard"))
            .alias("tft_game_type"),
            F.when(k % 11 == 0, F.lit("TFTSet9")).otherwise(F.lit("TFTSet10"))
            .alias("tft_set_core_name"),
            F.transform(_first(k % 9, SEATS), participant).alias("participants"),
        ).alias("info"),
    )
    deliveries = F.when(F.col("o_orderstatus") == "F", 2).otherwise(1)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    # making the documents is the work: a table that is one row group is dealt out before it, into parts
    # that do not grow with the table, since tasks sort what they make of theirs
    tasks = max(spark.sparkContext.defaultParallelism, -(-orders.count() // ORDERS_A_TASK))
    orders = orders.repartition(tasks, "o_orderkey")
    # A generator's output is made once: later filters run on it, not on the expression again.
    delivered = orders.select(F.explode(F.array_repeat(document, deliveries)).alias("document"))
    return delivered.select("document.*")


# -- logs ----------------------------------------------------------------------------------

EVENTS = schemas.struct(
    event_id=schemas.LONG, ts=T.TimestampNTZType(), user_id=schemas.LONG,
    event_type=schemas.STRING, value=schemas.DOUBLE, props=schemas.STRING,
)


def log_records(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as log records; the odd ones stamped at +02:00."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind, amount = F.col("event_type"), F.floor(F.col("value") * 10).cast("int")
    product = F.element_at(F.array(*map(F.lit, PRODUCTS)), k % 4 + 1)
    path = (
        F.when(kind == "signup", F.lit("/register"))
        .when(kind == "purchase", F.concat(F.lit("/buy?product="), product, F.lit("&rp="), amount))
        .when(kind == "error", F.lit("/status"))
        .otherwise(F.lit("/game/start"))
    )
    status = F.when(kind == "error", F.when(k % 2 == 0, 500).otherwise(404)).otherwise(
        F.when(k % 10 == 0, 301).otherwise(200)
    )
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    local = F.col("ts") + F.expr("interval 2 hours")
    return events.select(
        F.col("user_id").cast("string").alias("puuid"),
        F.when(k % 2 == 0, F.concat(F.date_format("ts", iso), F.lit("+00:00")))
        .otherwise(F.concat(F.date_format(local, iso), F.lit("+02:00")))
        .alias("timestamp"),
        F.lit("POST").alias("request_type"),
        path.alias("endpoint_path"),
        status.alias("status_code"),
        (F.col("event_id") % 10000).cast("int").alias("response_size"),
        amount.alias("response_time"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_records(table(spark, sf_dir, "events"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver logs of the events table."""
    return log_rows.silver_logs(log_rows.bronze_logs(records(spark, sf_dir)))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    return file_stream(spark, sf_dir, EVENTS, pathGlobFilter="events.parquet")


def record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_records(event_stream(spark, sf_dir))


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver logs of the event stream."""
    return log_rows.silver_logs(log_rows.bronze_logs(record_stream(spark, sf_dir)))

