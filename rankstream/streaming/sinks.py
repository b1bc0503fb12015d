"""Stream sinks that drain what is available and stop."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rankstream.sinks import folders
from rankstream.sinks.store import TableStore

_PREFIX = "snapshot-"


def append_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Appends new rows to a parquet folder; the folder's log gives exactly-once rows."""
    writer = df.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()


def snapshot_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    keep_hours: float = 24,
    on_snapshot: Callable[[str], None] | None = None,
) -> None:
    """Complete-mode sink: every micro-batch writes the whole result as its own snapshot.

    A repeated batch overwrites its own snapshot only, and readers take the newest committed one.
    Small state partitions are merged, and large ones split, before the write. ``on_snapshot`` gets
    the folder of each new snapshot before any old one is dropped; one that a newer one replaced
    stays readable for ``keep_hours``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.hint("rebalance", *partition_by).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        snapshot = f"{path}/{_PREFIX}{batch_id:012d}"
        writer.parquet(snapshot)
        if on_snapshot:
            on_snapshot(snapshot)
        spark = batch.sparkSession
        committed = _committed(spark, path)
        for old, newer in zip(committed, committed[1:]):
            if folders.age_hours(spark, f"{path}/{newer}/_SUCCESS") > keep_hours:
                folders.drop(spark, f"{path}/{old}")

    query = (
        df.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def update_stream(
    df: DataFrame,
    store: TableStore,
    name: str,
    keys: Sequence[str],
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Update-mode sink: every micro-batch upserts the groups that it changed, and no others.

    A changed group comes with its whole new value, so a batch that is repeated changes nothing.
    Partitions without a changed group keep their files.
    """

    def write(batch: DataFrame, _: int) -> None:
        store.upsert(name, batch, keys, partition_by=partition_by)

    query = (
        df.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def for_each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands every micro-batch and its number to ``write``, which must give the same when repeated."""
    query = (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _committed(spark: SparkSession, path: str) -> list[str]:
    names = [n for n in folders.children(spark, path) if n.startswith(_PREFIX)]
    return [n for n in names if folders.exists(spark, f"{path}/{n}/_SUCCESS")]


def newest_snapshot(spark: SparkSession, path: str) -> str:
    """Folder of the newest committed snapshot of :func:`snapshot_stream`."""
    committed = _committed(spark, path)
    if not committed:
        raise FileNotFoundError(f"no committed snapshot under {path}")
    return f"{path}/{committed[-1]}"


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest committed snapshot as a frame; without rows it can only be read by ``schema``."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(newest_snapshot(spark, path))
