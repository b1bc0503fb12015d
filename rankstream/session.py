"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job wants. Partition counts and memory belong to the cluster's submit
# command, so none are set here; AQE sizes the shuffles from what was really written.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "rankstream", master: str | None = None, hive: bool = False, **conf: str
) -> SparkSession:
    """A session with :data:`DEFAULTS`; ``conf`` keys use ``__`` for dots.

    ``hive`` uses the cluster's metastore, which jobs that run as separate applications share.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else the warehouse.

    Both are paths of the cluster's file system; neither is ever a machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path under :func:`shared_folder`."""
    return f"{shared_folder(spark)}/rankstream/{label}-{uuid.uuid4().hex}"
