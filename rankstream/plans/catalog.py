"""The registered queries: every operator over the test tables.

Each takes ``(spark, sf_dir)`` and returns a frame in comparable form (see :func:`comparable`).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankstream import schemas
from rankstream.functions import requests
from rankstream.operators import (
    compositions, dedupe, deltas, nested, ranking, rates, sketches, summaries,
)
from rankstream.plans import adapters
from rankstream.session import shared_folder
from rankstream.sinks import folders, gold
from rankstream.sinks.publish import publish
from rankstream.sinks.runs import write_run
from rankstream.sinks.store import TableStore
from rankstream.sources import landing, records
from rankstream.sources.streams import file_stream
from rankstream.streaming import logs as log_rows
from rankstream.streaming import metrics, quality
from rankstream.streaming.sinks import append_stream, read_snapshot, snapshot_stream, update_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to 6 places, times and dates as text, so that engines can be compared by value."""

    def shape(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[shape(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


def _folder(spark: SparkSession, sf_dir: str, label: str) -> str:
    """The query's working folder for this input, emptied of an earlier run's data."""
    place = zlib.crc32(sf_dir.encode())
    folder = f"{shared_folder(spark)}/rankstream/queries/{label}-{place:08x}"
    folders.drop(spark, folder)
    return folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> TableStore:
    """A store in which the table ``name`` is yet to be made."""
    store = TableStore(spark, _folder(spark, sf_dir, name))
    store.initialize()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return store


# -- sources -------------------------------------------------------------------------------


def _champions(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Entries read from multi-line JSON files, each a list of documents."""
    folder = _folder(spark, sf_dir, label)
    texts = adapters.catalogue_documents(spark, sf_dir)
    texts.write.partitionBy("file").text(folder)
    entries = landing.read_catalogue(spark, folder, "champions")
    return entries.select("id", "name", "tier")


@query
def json_inline(spark, sf_dir):
    return _champions(spark, sf_dir, "champions")


@query
def static_dedupe(spark, sf_dir):
    return dedupe.first_per_key(_champions(spark, sf_dir, "names"), ["name"])


def _landed(spark: SparkSession, sf_dir: str, df: DataFrame, label: str) -> str:
    folder = _folder(spark, sf_dir, label)
    df.write.json(folder, compression="gzip")
    return folder


@query
def players_ingest(spark, sf_dir):
    folder = _landed(spark, sf_dir, adapters.league_entries(spark, sf_dir), "entries")
    return landing.queue_players(landing.read_league_entries(spark, folder)).drop("idx")


_PARTICIPANT_FIELDS = (
    "match_id", "game_length", "puuid", "placement", "level", "gold_left", "time_eliminated",
    "total_damage_to_players",
)


@query
def matches_ingest(spark, sf_dir):
    folder = _landed(spark, sf_dir, adapters.match_documents(spark, sf_dir), "documents")
    rows = nested.flatten_documents(landing.read_match_documents(spark, folder))
    return rows.select(
        *_PARTICIPANT_FIELDS,
        "outcome",
        F.coalesce(F.size("augments"), F.lit(-1)).alias("augment_count"),
        F.coalesce(F.size("traits"), F.lit(-1)).alias("trait_count"),
        F.coalesce(F.size("units"), F.lit(-1)).alias("unit_count"),
    )


@query
def scan_table(spark, sf_dir):
    name = "silver.scanned"
    store = _table(spark, sf_dir, name)
    store.append(name, adapters.matches(spark, sf_dir))
    return store.read(name).select("match_id", "puuid", "placement", "level", "tier")


def _drained(
    spark: SparkSession, sf_dir: str, df: DataFrame, label: str, partition_by=(), runs: int = 1
) -> DataFrame:
    folder = _folder(spark, sf_dir, label)
    for _ in range(runs):
        append_stream(df, f"{folder}/data", f"{folder}/checkpoint", partition_by)
    return spark.read.schema(df.schema).parquet(f"{folder}/data")


@query
def stream_scan(spark, sf_dir):
    events = adapters.event_stream(spark, sf_dir)
    picked = events.select("event_id", "user_id", "event_type", "value")
    return _drained(spark, sf_dir, picked, "scan")


@query
def stream_restart(spark, sf_dir):
    """A second start on the same checkpoint adds nothing."""
    events = adapters.event_stream(spark, sf_dir)
    picked = events.select("event_id", "user_id", "event_type", "value")
    return _drained(spark, sf_dir, picked, "restart", runs=2)


@query
def decode_records(spark, sf_dir):
    return records.decode(records.encode(adapters.records(spark, sf_dir)))


@query
def unprocessed_players(spark, sf_dir):
    return dedupe.unprocessed(_marked(spark, sf_dir)).select("puuid", "queueType", "wins")


# -- sinks ---------------------------------------------------------------------------------


@query
def write_partitioned(spark, sf_dir):
    name = "bronze.partitioned"
    store = _table(spark, sf_dir, name)
    store.append(name, adapters.matches(spark, sf_dir), ["outcome"])
    return store.read(name).select("match_id", "puuid", "placement", "outcome")


def _player_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return adapters.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), key).alias("puuid"),
        F.col("c_mktsegment").alias("tier"),
        (key % 50).alias("wins"),
    )


def _player_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as updates; half of the players are new, the latest order counts."""
    orders = adapters.table(spark, sf_dir, "orders")
    return orders.select(
        F.concat(F.lit("P"), F.col("o_custkey") * 2).alias("puuid"),
        F.concat(F.lit("NEW-"), F.col("o_orderstatus")).alias("tier"),
        (F.col("o_orderkey") % 50).alias("wins"),
        "o_orderdate",
        "o_orderkey",
    )


def _latest_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    updates = _player_updates(spark, sf_dir)
    return dedupe.first_per_key(updates, ["puuid"], order).drop("o_orderdate", "o_orderkey")


@query
def upsert_merge(spark, sf_dir):
    return dedupe.merge_rows(
        _player_base(spark, sf_dir), _latest_updates(spark, sf_dir), ["puuid"]
    )


@query
def write_or_upsert(spark, sf_dir):
    name = "silver.upserted"
    store = _table(spark, sf_dir, name)
    for rows in (_player_base(spark, sf_dir), _latest_updates(spark, sf_dir)):
        store.write_or_upsert(name, rows, ["puuid"], partition_by=["tier"])
    return store.read(name).select("puuid", "tier", "wins")


@query
def upsert_buckets(spark, sf_dir):
    """The same into a table that is partitioned by a bucket of its key."""
    name = "silver.bucketed"
    store = _table(spark, sf_dir, name)
    for rows in (_player_base(spark, sf_dir), _latest_updates(spark, sf_dir)):
        store.write_or_upsert(name, rows, ["puuid"])
    return store.read(name).select("puuid", "tier", "wins")


@query
def widened_types(spark, sf_dir):
    """Deliveries with wider numbers widen the columns of rows that are stored already.

    Even orders come in the narrow types, or, where a value passes those, in a delivery of their own.
    """
    name = "silver.widened"
    store = _table(spark, sf_dir, name)
    orders = adapters.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    key, player, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    even = orders.filter("o_orderkey % 2 = 0")
    # a null fits every type; try_cast gives one also for what does not fit
    outside = [
        value.isNotNull() & value.try_cast(kind).isNull()
        for value, kind in ((key, "int"), (player, "smallint"), (F.floor(price), "int"))
    ]
    fits = ~(outside[0] | outside[1] | outside[2])
    narrow = even.filter(fits).select(
        key.cast("int").alias("id"), player.cast("smallint").alias("player"),
        F.floor(price).cast("int").alias("total"), (key % 8).cast("float").alias("share"),
    )
    larger = even.filter(~fits).select(
        key.alias("id"), player.alias("player"), F.floor(price).alias("total"),
        (key % 8).cast("float").alias("share"),
    )
    wide = orders.filter("o_orderkey % 2 = 1").select(
        (key * 10_000_000_000).alias("id"), player.alias("player"),
        F.floor(price * 1_000_000_000).alias("total"), (key / 3).alias("share"),
    )
    for rows in (narrow, larger, wide):
        store.append(name, rows)
    return store.read(name)


@query
def z_ordered(spark, sf_dir):
    """A predicate on two columns of a table that is clustered by both."""
    name = "silver.clustered"
    store = _table(spark, sf_dir, name)
    store.append(name, adapters.matches(spark, sf_dir))
    store.cluster(name, ["total_damage_to_players", "gold_left"])
    near = F.col("total_damage_to_players").between(30, 60) & F.col("gold_left").between(10, 19)
    return store.read(name).filter(near).select("match_id", "puuid", "gold_left", "level")


@query
def bucket_growth(spark, sf_dir):
    """Upserts into a table whose buckets double as they fill."""
    name = "silver.growing"
    store = _table(spark, sf_dir, name)
    store.buckets, store.bucket_bytes = 2, 8192
    for rows in (_player_base(spark, sf_dir), _latest_updates(spark, sf_dir)):
        store.write_or_upsert(name, rows, ["puuid"])
    return store.read(name).select("puuid", "tier", "wins")


@query
def publish_gold(spark, sf_dir):
    target = _folder(spark, sf_dir, "published")
    gold = summaries.player_metrics(_players(spark, sf_dir))
    for _ in range(2):  # a repeated run must not double its rows
        publish(gold, target, run_id="r1", fmt="json")
    return spark.read.schema(gold.schema).json(f"{target}/run_id=r1")


@query
def publish_runs(spark, sf_dir):
    """Two runs through the committing sink, the first one written twice."""
    target = _folder(spark, sf_dir, "runs")
    players = _players(spark, sf_dir).select("puuid", "tier", "wins")
    for run, rows in (("r1", players), ("r1", players), ("r2", players.filter("wins > 25"))):
        write_run(rows, target, run)
    kind = T.StructType([*players.schema.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(kind).parquet(target)


@query
def stream_append(spark, sf_dir):
    written = _drained(spark, sf_dir, adapters.log_stream(spark, sf_dir), "append", ["date"])
    return written.select("puuid", "timestamp", "status_code", "action", "date")


def _snapshot(
    spark: SparkSession, sf_dir: str, df: DataFrame, label: str, partition_by=()
) -> DataFrame:
    folder = _folder(spark, sf_dir, label)
    snapshot_stream(df, f"{folder}/data", f"{folder}/checkpoint", partition_by)
    return read_snapshot(spark, f"{folder}/data", df.schema).select(*df.columns)


@query
def stream_complete(spark, sf_dir):
    counts = adapters.log_stream(spark, sf_dir).groupBy("action", "status_code").count()
    return _snapshot(spark, sf_dir, counts, "complete")


_AS_OF = "2024-01-01 00:00:00"


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = landing.queue_players(adapters.league_entries(spark, sf_dir))
    done = adapters.processed_players(spark, sf_dir)
    return dedupe.mark_processed(queue, done, as_of=F.lit(_AS_OF).cast("timestamp"))


@query
def mark_processed(spark, sf_dir):
    return _marked(spark, sf_dir).select("puuid", "queueType", "wins", "processedTime")


# -- projections, filters, nested data -----------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.match_documents(spark, sf_dir)


def _silver_rows(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    rows = nested.flatten_documents(_documents(spark, sf_dir))
    return nested.dedupe_matches(rows, columns or None)


@query
def nested_project(spark, sf_dir):
    return nested.project_match(_documents(spark, sf_dir)).drop("participants")


@query
def struct_flatten(spark, sf_dir):
    matches = nested.project_match(_documents(spark, sf_dir))
    return nested.participants(matches).select(*_PARTICIPANT_FIELDS)


@query
def array_to_columns(spark, sf_dir):
    return nested.match_augments(_silver_rows(spark, sf_dir, "placement", "augments"))


@query
def traits_explode(spark, sf_dir):
    return nested.match_traits(_silver_rows(spark, sf_dir, "placement", "traits"))


@query
def units_posexplode(spark, sf_dir):
    return nested.match_units(_silver_rows(spark, sf_dir, "placement", "units"))


@query
def match_filter(spark, sf_dir):
    return nested.ranked_matches(nested.project_match(_documents(spark, sf_dir))).drop(
        "participants"
    )


@query
def solo_matches(spark, sf_dir):
    matches = nested.solo_matches(nested.project_match(_documents(spark, sf_dir)))
    return matches.drop("participants")


@query
def item_exclusion(spark, sf_dir):
    return rates.without_items(adapters.match_units(spark, sf_dir), adapters.EXCLUDED_ITEMS)


@query
def surrogate_key(spark, sf_dir):
    queue = landing.queue_players(adapters.league_entries(spark, sf_dir))
    ids = queue.groupBy("idx", "puuid").agg(F.count(F.lit(1)).alias("entries"))
    per_id = ids.groupBy("idx").agg(
        F.max("puuid").alias("puuid"),
        F.count(F.lit(1)).alias("players_with_id"),
        F.sum("entries").alias("entries"),
    )
    return per_id.drop("idx")


@query
def outcome_label(spark, sf_dir):
    seats = adapters.matches(spark, sf_dir).select("match_id", "puuid", "placement")
    return nested.with_outcome(seats)


@query
def players_silver(spark, sf_dir):
    return _players(spark, sf_dir)


def _players(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = adapters.league_entries(spark, sf_dir).drop("queueType")
    return dedupe.first_per_key(entries, ["puuid"], [F.desc("wins")])


@query
def wins_only(spark, sf_dir):
    name = "bronze.pruned"
    store = _table(spark, sf_dir, name)
    store.append(name, adapters.matches(spark, sf_dir), ["outcome"])
    return store.read(name).where(F.col("outcome") == "win").select("match_id", "puuid", "level")


@query
def dedupe_by_key(spark, sf_dir):
    return _silver_rows(spark, sf_dir, *_PARTICIPANT_FIELDS, "outcome")


@query
def match_summary(spark, sf_dir):
    """The silver build: one stored dedupe, of which the summary table is upserted.

    Nested columns have their part in the dedupe by a hash; the summary does not hold them, so they stay behind.
    """
    name = "silver.summaries"
    store = _table(spark, sf_dir, name)
    flat = nested.match_summary(nested.flatten_documents(_documents(spark, sf_dir)))
    with store.staging() as stage:
        summary = stage(_silver_rows(spark, sf_dir, *flat.columns))
        for _ in range(2):  # a repeated delivery changes nothing
            store.write_or_upsert(
                name, summary, nested.MATCH_KEY, partition_by=["outcome"], prepared=True
            )
    return store.read(name).select(*_PARTICIPANT_FIELDS, "outcome")


# -- joins ---------------------------------------------------------------------------------


@query
def trait_pairs(spark, sf_dir):
    return compositions.trait_pairs(adapters.match_traits(spark, sf_dir))


@query
def stream_static_join(spark, sf_dir):
    logs, matches = adapters.log_stream(spark, sf_dir), adapters.matches(spark, sf_dir)
    joined = metrics.with_match_record(logs, matches, salts=8).select(
        "puuid", "timestamp", "action", "matches_played", "placement_sum"
    )
    return _drained(spark, sf_dir, joined, "joined")


@query
def stream_log_matches(spark, sf_dir):
    """Row by row: every request beside every match of its player."""
    logs, matches = adapters.log_stream(spark, sf_dir), adapters.matches(spark, sf_dir)
    joined = metrics.with_matches(logs, matches, salts=4).select(
        "puuid", "timestamp", "action", "match_id", "placement"
    )
    return _drained(spark, sf_dir, joined, "joined-rows")


# -- metric tables -------------------------------------------------------------------------


@query
def rate_table(spark, sf_dir):
    return rates.rate_table(adapters.matches(spark, sf_dir), ["tier", "level"])


@query
def trait_metrics(spark, sf_dir):
    return rates.trait_metrics(adapters.match_traits(spark, sf_dir))


@query
def item_metrics(spark, sf_dir):
    return rates.item_metrics(adapters.match_units(spark, sf_dir))


@query
def champion_metrics(spark, sf_dir):
    return rates.champion_metrics(adapters.match_units(spark, sf_dir))


@query
def champion_item_metrics(spark, sf_dir):
    units = adapters.match_units(spark, sf_dir)
    return rates.champion_item_metrics(units, excluded=adapters.EXCLUDED_ITEMS)


@query
def augment_metrics(spark, sf_dir):
    return rates.augment_metrics(adapters.match_augments(spark, sf_dir))


@query
def composition_metrics(spark, sf_dir):
    return compositions.composition_metrics(adapters.match_traits(spark, sf_dir))


@query
def placement_metrics(spark, sf_dir):
    return summaries.placement_metrics(adapters.matches(spark, sf_dir))


@query
def player_metrics(spark, sf_dir):
    return summaries.player_metrics(_players(spark, sf_dir))


@query
def topk_per_group(spark, sf_dir):
    counts = adapters.matches(spark, sf_dir).groupBy("tier", "level").count()
    return ranking.top_per_group(counts, ["tier"], [F.desc("count")], 3, tie_break=["level"])


@query
def topk_rank_ties(spark, sf_dir):
    counts = _players(spark, sf_dir).groupBy("tier", "wins").count()
    return ranking.top_ranked(counts, [F.desc("count")], 10)


@query
def augment_union(spark, sf_dir):
    picks = rates.augment_picks(adapters.match_augments(spark, sf_dir))
    return picks.groupBy("pick_order", "augment_id").count()


@query
def distinct_match_ids(spark, sf_dir):
    rows = nested.flatten_documents(_documents(spark, sf_dir))
    return rows.select("match_id").distinct()


# -- metric tables maintained from change feeds --------------------------------------------


def _maintained(
    spark: SparkSession, sf_dir: str, label: str, made: tuple, keys, metric: deltas.Metric, rows_of
) -> tuple[TableStore, str]:
    """The store and the gold table after two deliveries, the second one applied twice."""
    silver, target = f"silver.{label}", f"gold.{label}"
    store = _table(spark, sf_dir, silver)
    for name in (f"{silver}_changes", target):
        _table(spark, sf_dir, name)
    for number, rows in enumerate((made[0], made[1], made[1])):
        delivery = f"d{min(number, 1)}"
        store.upsert(silver, rows, keys, delivery=delivery)
        gold.apply_delivery(store, target, metric, rows_of(store.changes(silver, delivery)), delivery)
    return store, target


@query
def rate_deltas(spark, sf_dir):
    metric = deltas.rate_metric(["tier", "level"])
    made = adapters.match_deliveries(spark, sf_dir)
    store, target = _maintained(spark, sf_dir, "kept_rates", made, ["seat"], metric, lambda f: f)
    return gold.read_metric(store, target, metric)


@query
def placement_deltas(spark, sf_dir):
    metric = deltas.placement_metric()
    made = adapters.match_deliveries(spark, sf_dir)
    store, target = _maintained(spark, sf_dir, "kept_places", made, ["seat"], metric, lambda f: f)
    gold.compact(store, target, metric, "all")
    return gold.read_metric(store, target, metric)


@query
def composition_deltas(spark, sf_dir):
    """Pairs of traits from whole boards, as their rows come and go together; the boards are made once."""
    matches_kept = adapters.table(spark, sf_dir, "lineitem").filter(
        "l_orderkey % 5 <> 0 OR l_orderkey % 3 = 0"
    )
    count = compositions.distinct_matches(matches_kept.selectExpr("l_orderkey div 8 AS match_id"))
    metric = deltas.composition_metric(count, boards=True)
    folder = _folder(spark, sf_dir, "boards")
    boards = adapters.boards(spark, sf_dir)
    boards.write.parquet(folder)
    made = adapters.board_deliveries(spark.read.schema(boards.schema).parquet(folder))
    store, target = _maintained(
        spark, sf_dir, "kept_boards", made, ["match_id", "puuid"], metric, lambda f: f
    )
    return gold.read_metric(store, target, metric)


# -- stored sketches and bitmaps -----------------------------------------------------------


@query
def latency_sketches(spark, sf_dir):
    """Per day the requests, and whether each quantile merged from stored hours has its rank.

    A value has rank r within the error if at most r + error of the day's times lie below it and at
    least r - error do not lie above it; the error is three times the one stated for the sketch.
    """
    logs = adapters.logs(spark, sf_dir)
    folder = _folder(spark, sf_dir, "latency")
    sketches.latency_sketches(logs).write.parquet(folder)
    days = sketches.quantiles(sketches.coarser(spark.read.parquet(folder), "day"))
    day = F.date_trunc("day", "timestamp")
    timed = logs.select(day.alias("start"), "response_time").join(days, "start")
    found = []
    for rank in (0.5, 0.95, 0.99):
        name = f"response_time_{round(100 * rank)}p"
        below = F.avg((F.col("response_time") < F.col(name)).cast("int"))
        upto = F.avg((F.col("response_time") <= F.col(name)).cast("int"))
        error = 3 * sketches.RANK_ERROR
        found.append(((below <= rank + error) & (upto >= rank - error)).alias(f"{name}_close"))
    return timed.groupBy("start").agg(F.max("requests").alias("requests"), *found)


@query
def weekly_users_sketch(spark, sf_dir):
    """Users of the last seven days from stored daily sketches, against the exact counts."""
    logs = adapters.logs(spark, sf_dir)
    folder = _folder(spark, sf_dir, "users")
    sketches.user_sketches(logs).write.parquet(folder)
    guess = sketches.users_in_last_days(spark.read.parquet(folder))
    exact = (
        logs.select("action", "puuid", F.date_trunc("day", "timestamp").cast("date").alias("first")).distinct()
        .withColumn("day", F.explode(F.sequence(F.col("first"), F.date_add("first", 6))))
        .groupBy("action", "day").agg(F.count_distinct("puuid").alias("exact"))
    )
    same = guess["action"].eqNullSafe(exact["action"]) & (guess["day"] == exact["day"])
    off = F.abs(F.col("users") - F.col("exact"))
    # a small set is held almost exactly; the bound leaves it one user
    close = off <= F.greatest(3 * sketches.USERS_ERROR * F.col("exact"), F.lit(1.0))
    return guess.join(exact, same).select(
        guess["action"], guess["day"], "requests", F.col("exact").alias("users"),
        close.alias("estimate_is_close"),
    )


@query
def weekly_users_bitmap(spark, sf_dir):
    """The same exactly, from stored daily bitmaps over numbered users."""
    logs = adapters.logs(spark, sf_dir)
    folder = _folder(spark, sf_dir, "bitmaps")
    logs.select("puuid").distinct().write.parquet(f"{folder}/ids")
    numbers = sketches.numbered(spark.read.parquet(f"{folder}/ids"))
    sketches.user_bitmaps(logs, numbers).write.parquet(f"{folder}/days")
    return sketches.exact_users_in_last_days(spark.read.parquet(f"{folder}/days"))


# -- log functions and metrics -------------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rows.bronze_logs(adapters.records(spark, sf_dir))


def _by_path(spark: SparkSession, sf_dir: str, name: str, value) -> DataFrame:
    rows = adapters.records(spark, sf_dir).select("endpoint_path", value.alias(name))
    return rows.groupBy("endpoint_path", name).agg(F.count(F.lit(1)).alias("requests"))


@query
def log_action(spark, sf_dir):
    return _by_path(spark, sf_dir, "action", requests.action(F.col("endpoint_path")))


@query
def log_product(spark, sf_dir):
    return _by_path(spark, sf_dir, "product", requests.product(F.col("endpoint_path")))


@query
def log_price(spark, sf_dir):
    return _by_path(spark, sf_dir, "rp", requests.price(F.col("endpoint_path")))


@query
def log_date(spark, sf_dir):
    return _bronze(spark, sf_dir).groupBy("date").agg(F.count(F.lit(1)).alias("requests"))


@query
def server_metrics(spark, sf_dir):
    return metrics.window_bounds(metrics.server_metrics(adapters.logs(spark, sf_dir)))


@query
def transaction_metrics(spark, sf_dir):
    return metrics.window_bounds(metrics.transaction_metrics(adapters.logs(spark, sf_dir)))


# Spark's default relative standard deviation of approximate distinct counts.
_STATED_ERROR = 0.05


def _against_exact(spark: SparkSession, sf_dir: str, estimated: DataFrame) -> DataFrame:
    """Exact counts, and whether the estimate lies within three times its stated error."""
    exact = metrics.engagement_metrics(adapters.logs(spark, sf_dir), exact=True)
    guess = estimated.select(
        F.col("action").alias("__action"), F.col("time_window").alias("__window"),
        F.col("unique_users_count").alias("__users"), F.col("requests_count").alias("__requests"),
    )
    on = F.col("action").eqNullSafe(F.col("__action")) & (F.col("time_window") == F.col("__window"))
    off = F.abs(F.col("__users") - F.col("unique_users_count"))
    close = (off <= 3 * _STATED_ERROR * F.col("unique_users_count")) & (
        F.col("__requests") == F.col("requests_count")
    )
    joined = exact.join(guess, on, "full_outer").withColumn("estimate_is_close", close)
    return metrics.window_bounds(joined.select(*exact.columns, "estimate_is_close"))


@query
def engagement_metrics(spark, sf_dir):
    live = metrics.engagement_metrics(adapters.logs(spark, sf_dir))
    return _against_exact(spark, sf_dir, live)


@query
def engagement_exact(spark, sf_dir):
    logs = adapters.logs(spark, sf_dir)
    return metrics.window_bounds(metrics.engagement_metrics(logs, exact=True))


@query
def player_activity(spark, sf_dir):
    return metrics.window_bounds(metrics.player_activity(adapters.logs(spark, sf_dir)), "window")


@query
def placement_transactions(spark, sf_dir):
    logs, matches = adapters.logs(spark, sf_dir), adapters.matches(spark, sf_dir)
    return metrics.window_bounds(metrics.placement_transactions(logs, matches), "window")


@query
def logs_bronze(spark, sf_dir):
    wire = records.encode(adapters.record_stream(spark, sf_dir))
    return _drained(spark, sf_dir, log_rows.bronze_logs(records.decode(wire)), "bronze", ["date"])


def _damaged(wire: DataFrame) -> DataFrame:
    """Every seventh payload cut short, every fifth without its path."""
    text = F.substring("value", records.HEADER_BYTES + 1, 1_000_000).cast("string")
    size = F.get_json_object(text, "$.response_size").cast("int")
    cut = F.substring(F.col("value"), F.lit(1), F.length("value") - 2)
    gone = F.regexp_replace(text, '"endpoint_path":"[^"]*",', "").cast("binary")
    header = F.substring("value", 1, records.HEADER_BYTES)
    return wire.select(
        F.when(size % 7 == 0, cut).when(size % 5 == 0, F.concat(header, gone)).otherwise(F.col("value"))
        .alias("value")
    )


@query
def stream_quality(spark, sf_dir):
    """Counts of a stream of partly damaged records, and the rows that went either way."""
    names = [f"bronze.{n}" for n in ("checked_logs", "unread_logs", "quality_counts")]
    for name in names:
        store = _table(spark, sf_dir, name)
    wire = _damaged(records.encode(adapters.record_stream(spark, sf_dir)))
    quality.drain_checked(wire, store, *names, f"{_folder(spark, sf_dir, 'quality')}/checkpoint")
    kept = store.read(names[0]).agg(F.count(F.lit(1)).alias("kept"), F.sum("response_time").alias("times"))
    set_aside = store.read(names[1]).agg(F.count(F.lit(1)).alias("set_aside"))
    found = store.read(names[2]).agg(
        *[F.sum(c).alias(c) for c in ("arrived", "undecodable", "defaulted")]
    )
    sums = [df.withColumn("one", F.lit(1)) for df in (found, kept, set_aside)]  # one row each
    return sums[0].join(sums[1], "one").join(sums[2], "one").drop("one")


@query
def stream_chain(spark, sf_dir):
    """Bronze log files, written by one stream, are the source of the next."""
    bronze = log_rows.bronze_logs(records.decode(records.encode(adapters.record_stream(spark, sf_dir))))
    folder = _folder(spark, sf_dir, "chain")
    append_stream(bronze, f"{folder}/bronze", f"{folder}/checkpoint-bronze", ["date"])
    arrived = file_stream(spark, f"{folder}/bronze", schemas.BRONZE_LOG)
    return _drained(spark, sf_dir, log_rows.silver_logs(arrived), "chained", ["date"])


@query
def stream_late_rows(spark, sf_dir):
    """Hours closed by a watermark: odd events come after the even ones have closed theirs."""
    folder = _folder(spark, sf_dir, "late")
    logs = adapters.logs(spark, sf_dir).withColumn("odd", F.col("response_size") % 2)
    for odd in (0, 1):
        logs.filter(F.col("odd") == odd).drop("odd").write.mode("append").parquet(f"{folder}/in")
        live = metrics.server_metrics(
            file_stream(spark, f"{folder}/in", schemas.SILVER_LOG), delay="10 minutes"
        )
        append_stream(live, f"{folder}/out", f"{folder}/checkpoint")
    closed = spark.read.schema(live.schema).parquet(f"{folder}/out")
    return metrics.window_bounds(closed.select("time_window", "request_count"))


@query
def logs_enriched(spark, sf_dir):
    return adapters.logs(spark, sf_dir)


# -- the same metrics maintained by streams ------------------------------------------------


@query
def stream_server_metrics(spark, sf_dir):
    live = metrics.server_metrics(adapters.log_stream(spark, sf_dir))
    return metrics.window_bounds(_snapshot(spark, sf_dir, live, "server"))


@query
def stream_update_server(spark, sf_dir):
    """Hours kept by an update-mode stream over three arrivals."""
    name = "gold.server_hours"
    store = _table(spark, sf_dir, name)
    folder = _folder(spark, sf_dir, "updates")
    logs = adapters.logs(spark, sf_dir)
    for part in range(3):
        logs.filter(F.col("response_size") % 3 == part).write.mode("append").parquet(f"{folder}/in")
        arrived = file_stream(spark, f"{folder}/in", schemas.SILVER_LOG)
        live = metrics.window_bounds(metrics.server_metrics(arrived))
        dated = live.withColumn("day", F.to_date("window_start"))
        update_stream(dated, store, name, ["window_start"], f"{folder}/checkpoint", ["day"])
    return store.read(name).drop("day")


@query
def stream_transaction_metrics(spark, sf_dir):
    live = metrics.transaction_metrics(adapters.log_stream(spark, sf_dir))
    return metrics.window_bounds(_snapshot(spark, sf_dir, live, "transactions", ["date"]))


@query
def stream_engagement_metrics(spark, sf_dir):
    live = metrics.engagement_metrics(adapters.log_stream(spark, sf_dir))
    return _against_exact(spark, sf_dir, _snapshot(spark, sf_dir, live, "engagement", ["date"]))


@query
def stream_player_activity(spark, sf_dir):
    live = metrics.player_activity(adapters.log_stream(spark, sf_dir))
    return metrics.window_bounds(_snapshot(spark, sf_dir, live, "activity", ["date"]), "window")


@query
def stream_placement_transactions(spark, sf_dir):
    logs, matches = adapters.log_stream(spark, sf_dir), adapters.matches(spark, sf_dir)
    live = metrics.placement_transactions(logs, matches)
    return metrics.window_bounds(_snapshot(spark, sf_dir, live, "placements", ["date"]), "window")
