"""Counts of what goes wrong in a log stream, batch by batch, and a table of what could not be read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.sinks.store import TableStore
from rankstream.sources import records

BATCH = "batch_id"
OBSERVED = "log_quality"
COUNTS = schemas.struct(
    batch_id=schemas.LONG, arrived=schemas.LONG, undecodable=schemas.LONG, defaulted=schemas.LONG,
)


def _counts() -> list:
    unread = F.col("unread")
    return [
        F.count(F.lit(1)).alias("arrived"),
        F.count_if(unread).alias("undecodable"),
        F.count_if(~unread & (F.col("defaulted") > 0)).alias("defaulted"),
    ]


def decode_observed(wire: DataFrame, observation: Observation | str = OBSERVED) -> DataFrame:
    """Decoded records with ``unread`` and ``defaulted`` (how many fields took their default).

    Counts are observed as the rows pass; they cost no pass of their own. A stream gives them with
    each batch's progress under the observation's name.
    """
    return records.decode_flagged(wire).observe(observation, *_counts())


def drain_checked(
    wire: DataFrame, store: TableStore, good: str, bad: str, counts: str, checkpoint: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Streams wire records to ``good``; payloads that cannot be read go to ``bad`` as they came.

    Every table has a partition per batch, which a repeated batch replaces. ``counts`` has a row for
    each batch: rows that arrived, could not be read, or took a default in a field.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation(OBSERVED)
        number = F.lit(batch_id).cast("long").alias(BATCH)
        with store.staging() as stage:
            flagged = stage(decode_observed(batch, seen))
            fields = [f.name for f in schemas.LOG_RECORD.fields]
            read = flagged.filter(~F.col("unread")).select(*fields, number)
            store.replace_partitions(good, read, [*partition_by, BATCH])
            unread = flagged.filter("unread").select("value", number)
            store.replace_partitions(bad, unread, [BATCH])
        found = seen.get
        row = (batch_id, found["arrived"], found["undecodable"], found["defaulted"])
        store.replace_partitions(counts, spark.createDataFrame([row], COUNTS), [BATCH])

    query = (
        wire.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def late_rows(progress: dict) -> int:
    """Rows that a batch's watermark dropped, from a query's progress."""
    return sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])


def progress_counts(spark: SparkSession, progress: Sequence[dict], name: str = OBSERVED) -> DataFrame:
    """A row per batch of a query's progress: the observed counts and the rows dropped as late."""
    kind = schemas.struct(**{f.name: f.dataType for f in COUNTS.fields}, late=schemas.LONG)
    rows = []
    for each in progress:
        row = each["observedMetrics"].get(name)
        seen = row.asDict() if row else {}
        rows.append((each["batchId"], *(seen.get(f) for f in COUNTS.fieldNames()[1:]), late_rows(each)))
    return spark.createDataFrame(rows, kind)
