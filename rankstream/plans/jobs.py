"""The batch and stream jobs, bronze to silver to gold, in dependency order.

Ingest and preprocess jobs drain what is new since their last run and stop; gold jobs recompute
their table from silver and replace it, or keep it by signed deltas (``incremental``); either way groups
that vanished leave no rows behind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankstream import schemas
from rankstream.operators import compositions, dedupe, deltas, nested, rates, summaries
from rankstream.sinks import gold
from rankstream.sinks.publish import publish
from rankstream.sinks.store import TableStore
from rankstream.sources import landing, records, streams
from rankstream.streaming import logs, metrics
from rankstream.streaming.sinks import append_stream, for_each_batch, snapshot_stream


@dataclass
class Workspace:
    """Where a job reads and writes.

    With ``late`` (a watermark delay such as "10 minutes") the log metrics run in append mode:
    a window is written once, when it closes, and its state is dropped. Without it every run
    rewrites the whole metric table and keeps all windows in state, but for ``connection``, whose
    state would hold every player and day: it always closes windows, by default after 10 minutes.

    ``landing`` holds ``static/<kind>.json``, and the folders ``players``, ``matches`` (JSON
    lines) and ``logs`` (parquet with the topic's binary ``value``). With ``brokers`` the logs
    come from Kafka instead. ``publish_to`` names the serving target of published gold tables.

    ``incremental`` keeps change feeds of the match tables, from which gold tables are brought up to
    date by what came since the last run. It must be set from the first run on.
    """

    spark: SparkSession
    store: TableStore
    landing: str
    brokers: str | None = None
    topic: str = "server.logs"
    record_format: str = "json"
    publish_to: str | None = None
    publish_format: str = "parquet"
    run_id: str = "latest"
    late: str | None = None
    incremental: bool = False
    stream_options: dict[str, str] = field(default_factory=dict)

    def stream_path(self, table: str) -> str:
        return f"{self.store.root}/streams/{table.replace('.', '/')}"

    def checkpoint(self, job: str) -> str:
        return f"{self.store.root}/checkpoints/{job}"

    def read_stream(self, table: str, schema) -> DataFrame:
        """The folder an append job fills, as a stream."""
        return streams.file_stream(
            self.spark, self.stream_path(table), schema, **self.stream_options
        )

    def landed(self, folder: str, schema, fmt: str) -> DataFrame:
        return streams.file_stream(
            self.spark, f"{self.landing}/{folder}", schema, fmt, **self.stream_options
        )

    def show_as(self, table: str, path: str, schema: T.StructType) -> None:
        """Points the catalog name at a stream's folder, which may hold no rows yet."""
        rows = f"SELECT * FROM parquet.`{path}`"
        if self.spark.read.schema(schema).parquet(path).isEmpty():
            empty = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
            rows = f"SELECT {', '.join(empty)} WHERE false"
        self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS {rows}")


Job = Callable[[Workspace], None]
JOBS: dict[str, Job] = {}


def job(fn: Job) -> Job:
    JOBS[fn.__name__] = fn
    return fn


def run(workspace: Workspace, names: Iterable[str] | None = None) -> None:
    """Runs the named jobs (all by default) in dependency order."""
    wanted = set(JOBS if names is None else names)
    unknown = wanted - JOBS.keys()
    if unknown:
        raise KeyError(f"unknown jobs: {sorted(unknown)}")
    workspace.store.initialize()
    for name, body in JOBS.items():
        if name in wanted:
            body(workspace)


# -- ingest to bronze ----------------------------------------------------------------------

_CATALOGUE_COLUMNS = {
    "champions": ("id", "name", "tier"),
    "traits": ("id", "name"),
    "items": ("id", "name"),
    "augments": ("id", "name"),
}


@job
def ingest_static(ws: Workspace) -> None:
    for kind, columns in _CATALOGUE_COLUMNS.items():
        entries = landing.read_catalogue(ws.spark, f"{ws.landing}/static/{kind}.json", kind)
        ws.store.overwrite(f"bronze.{kind}", entries.select(*columns))


@job
def ingest_players(ws: Workspace) -> None:
    entries = ws.landed("players", schemas.LEAGUE_ENTRY, "json")

    def write(batch: DataFrame, _: int) -> None:
        queue = landing.queue_players(batch)
        ws.store.write_or_upsert("bronze.players", queue, ["idx", "puuid"], [F.desc("wins")])

    for_each_batch(entries, write, ws.checkpoint("ingest_players"))


@job
def preprocess_static(ws: Workspace) -> None:
    for kind in _CATALOGUE_COLUMNS:
        key = "name" if kind == "augments" else "id"
        ws.store.write_or_upsert(f"silver.{kind}", ws.store.read(f"bronze.{kind}"), [key])


@job
def preprocess_players(ws: Workspace) -> None:
    players = ws.store.read("bronze.players").select(
        "puuid", "summonerId", "tier", "rank", "wins", "losses", "hotStreak"
    )
    ws.store.write_or_upsert(
        "silver.players", players, ["puuid"], [F.desc("wins")], partition_by=["tier"]
    )


@job
def ingest_matches(ws: Workspace) -> None:
    documents = ws.landed("matches", schemas.MATCH_DOCUMENT, "json")
    rows = nested.flatten_documents(documents.filter(F.col("metadata.match_id").isNotNull()))
    path = ws.stream_path("bronze.matches")
    append_stream(rows, path, ws.checkpoint("ingest_matches"), ["outcome"])
    ws.show_as("bronze.matches", path, rows.schema)
    if ws.store.exists("bronze.players"):
        arrived = ws.read_stream("bronze.matches", schemas.BRONZE_MATCH)
        for_each_batch(
            arrived.select("puuid"), lambda batch, _: _mark(ws, batch), ws.checkpoint("mark_players")
        )


def _mark(ws: Workspace, players: DataFrame) -> None:
    """Stamps the queued players whose matches have arrived."""
    queue = dedupe.unprocessed(ws.store.read("bronze.players"))
    marked = dedupe.mark_processed(queue, players)
    done = marked.filter(F.col("processedTime").isNotNull())
    ws.store.upsert("bronze.players", done, ["idx", "puuid"])


@job
def preprocess_matches(ws: Workspace) -> None:
    def write(batch: DataFrame, number: int) -> None:
        deduped = nested.dedupe_matches(batch)
        feed = {"delivery": f"{number:012d}"} if ws.incremental else {}
        with ws.store.staging() as stage:
            # The wide dedupe runs once; the four tables then read the columns they need. Only
            # trait rows may still repeat a key, when a board lists a trait twice.
            rows, upsert = stage(deduped), ws.store.write_or_upsert
            key = nested.MATCH_KEY
            upsert("silver.match_augments", nested.match_augments(rows), key, prepared=True, **feed)
            upsert("silver.match_traits", nested.match_traits(rows), [*key, "trait_id"], **feed)
            upsert(
                "silver.match_units", nested.match_units(rows), [*key, "unit_ordinal", "pos"],
                prepared=True, **feed,
            )
            upsert(
                "silver.matches", nested.match_summary(rows), key, partition_by=["outcome"],
                prepared=True, **feed,
            )

    bronze = ws.read_stream("bronze.matches", schemas.BRONZE_MATCH)
    for_each_batch(bronze, write, ws.checkpoint("preprocess_matches"))


# -- gold ----------------------------------------------------------------------------------


# Gold tables that an incremental workspace keeps from change feeds. Pairs of traits need whole boards,
# which the feed of trait rows does not give, and players are few: those are recomputed.
_KEPT = {
    "trait_metrics": deltas.trait_metric(),
    "item_metrics": deltas.rate_metric(["item"]),
    "champion_metrics": deltas.rate_metric(["unit_id", "unit_tier"]),
    "champion_item_metrics": deltas.champion_item_metric(),
    "augment_metrics": deltas.augment_metric(),
    "placement_metrics": deltas.placement_metric(),
}


def _kept(ws: Workspace, name: str, source: str) -> DataFrame:
    """The metric after counting what came since the last run."""
    partials = f"gold.{name}_counts"
    gold.catch_up(ws.store, partials, _KEPT[name], source)
    return gold.read_metric(ws.store, partials, _KEPT[name])


def _gold(
    name: str,
    source: str,
    metric: Callable[[Workspace, DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
    published: bool = False,
) -> None:
    def body(ws: Workspace) -> None:
        table = f"gold.{name}"
        if ws.incremental and name in _KEPT:
            found = _kept(ws, name, source)
        else:
            found = metric(ws, ws.store.read(source))
        ws.store.overwrite(table, found, partition_by)
        if published and ws.publish_to:
            # from the written table, so that the metric is computed once
            target = f"{ws.publish_to}/{name}"
            publish(ws.store.read(table), target, ws.run_id, ws.publish_format)

    JOBS[name] = body


def _compositions(ws: Workspace, traits: DataFrame) -> DataFrame:
    """Every match has a row in ``silver.matches``, which is the smaller table to count."""
    matches = compositions.distinct_matches(ws.store.read("silver.matches"))
    return compositions.composition_metrics(traits, match_count=matches)


def _of(metric: Callable[[DataFrame], DataFrame]) -> Callable[[Workspace, DataFrame], DataFrame]:
    return lambda _, df: metric(df)


_gold("trait_metrics", "silver.match_traits", _of(rates.trait_metrics))
_gold("item_metrics", "silver.match_units", _of(rates.item_metrics))
_gold("champion_metrics", "silver.match_units", _of(rates.champion_metrics))
_gold(
    "champion_item_metrics", "silver.match_units", _of(rates.champion_item_metrics),
    published=True,
)
_gold(
    "augment_metrics", "silver.match_augments", _of(rates.augment_metrics), ["pick_order"],
    published=True,
)
_gold("composition_metrics", "silver.match_traits", _compositions, published=True)
_gold("placement_metrics", "silver.matches", _of(summaries.placement_metrics), published=True)
_gold("player_metrics", "silver.players", _of(summaries.player_metrics))


# -- logs ----------------------------------------------------------------------------------


@job
def ingest_logs(ws: Workspace) -> None:
    if ws.brokers:
        wire = streams.kafka_topic(ws.spark, ws.topic, ws.brokers, **ws.stream_options)
    else:
        wire = ws.landed("logs", schemas.WIRE_RECORD, "parquet")
    bronze = logs.bronze_logs(records.decode(wire, ws.record_format))
    path = ws.stream_path("bronze.logs")
    append_stream(bronze, path, ws.checkpoint("ingest_logs"), ["date"])
    ws.show_as("bronze.logs", path, bronze.schema)


@job
def preprocess_logs(ws: Workspace) -> None:
    silver = logs.silver_logs(ws.read_stream("bronze.logs", schemas.BRONZE_LOG))
    path = ws.stream_path("silver.logs")
    append_stream(silver, path, ws.checkpoint("preprocess_logs"), ["date"])
    ws.show_as("silver.logs", path, silver.schema)


def _log_gold(
    name: str,
    table: str,
    metric: Callable[[Workspace, DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
    always_close: bool = False,
) -> None:
    def body(ws: Workspace) -> None:
        live = metric(ws, ws.read_stream("silver.logs", schemas.SILVER_LOG))
        shown = f"gold.{table}"
        if ws.late or always_close:
            path = f"{ws.stream_path(shown)}-closed"
            append_stream(live, path, ws.checkpoint(f"{name}-closed"), partition_by)
            ws.show_as(shown, path, live.schema)
            return
        snapshot_stream(
            live,
            ws.stream_path(shown),
            ws.checkpoint(name),
            partition_by,
            on_snapshot=lambda folder: ws.show_as(shown, folder, live.schema),
        )

    JOBS[name] = body


def _connection(ws: Workspace, rows: DataFrame) -> DataFrame:
    # one row per player, made once a run instead of once a micro-batch
    record = metrics.match_record(ws.store.read("silver.matches"))
    ws.store.overwrite("silver.match_record", record)
    stored = ws.store.read("silver.match_record")
    return metrics.placement_transactions(rows, stored, ws.late or "10 minutes", recorded=True)


_log_gold("server_metrics", "server_metrics", lambda ws, rows: metrics.server_metrics(rows, ws.late))
_log_gold(
    "transaction_metrics", "transaction_metrics",
    lambda ws, rows: metrics.transaction_metrics(rows, ws.late), ["date"],
)
_log_gold(
    "engagement_metrics", "engagement_metrics",
    lambda ws, rows: metrics.engagement_metrics(rows, ws.late), ["date"],
)
_log_gold(
    "player_activity_metrics", "player_activity_metrics",
    lambda ws, rows: metrics.player_activity(rows, ws.late), ["date"],
)
_log_gold(
    "connection", "player_placement_transaction_connection", _connection, ["date"],
    always_close=True,
)
