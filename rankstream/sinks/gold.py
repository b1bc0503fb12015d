"""Metric tables maintained from change feeds.

Each delivery's partial counts are one partition of the table, so that applying a delivery again
replaces its own counts and nothing else. Reading adds the partitions up: they hold a row per group and
delivery, never match rows. ``compact`` makes one partition of all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankstream.operators.deltas import Metric, net
from rankstream.sinks.store import DELIVERY, TableStore


def apply_delivery(
    store: TableStore, name: str, metric: Metric, feed: DataFrame, delivery: str
) -> None:
    """Adds a delivery's change feed to the metric table; a repeated delivery counts once."""
    partial = metric.partial(feed).withColumn(DELIVERY, F.lit(delivery))
    store.replace_partitions(name, partial, [DELIVERY])


def deliveries(store: TableStore, name: str) -> set[str]:
    """The deliveries that a feed, or a metric table, has rows of: from the catalog, not the rows."""
    if not store.exists(name):
        return set()
    listed = store.spark.sql(f"SHOW PARTITIONS {name}").collect()  # one row per delivery
    return {row["partition"].removeprefix(f"{DELIVERY}=") for row in listed}


def catch_up(store: TableStore, name: str, metric: Metric, source: str) -> None:
    """Applies the deliveries of ``source`` that the metric table ``name`` has not counted yet."""
    if not store.exists(f"{source}_changes"):
        raise RuntimeError(f"{source} was filled without a change feed: compute {name} from it")
    for delivery in sorted(deliveries(store, f"{source}_changes") - deliveries(store, name)):
        apply_delivery(store, name, metric, store.changes(source, delivery), delivery)


def read_metric(store: TableStore, name: str, metric: Metric) -> DataFrame:
    """The metric table as of the last applied delivery."""
    return metric.finish(net(store.read(name).drop(DELIVERY), metric.keys))


def compact(store: TableStore, name: str, metric: Metric, label: str) -> None:
    """Makes one partition of all deliveries, which must not be applied again afterwards."""
    whole = net(store.read(name).drop(DELIVERY), metric.keys)
    store.rewrite(name, whole.withColumn(DELIVERY, F.lit(label)), [DELIVERY])
