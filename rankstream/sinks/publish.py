"""Publishing finished tables, and looking at frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_FORMATS = frozenset({"parquet", "json", "csv", "orc"})


def publish(
    df: DataFrame, target: str, run_id: str, fmt: str = "parquet", mode: str = "append", **options: str
) -> None:
    """Writes ``df`` to a serving store.

    File formats keep one ``run_id`` folder per run, so that a repeated run replaces its own rows
    and touches no other run's. Any other format goes to the named connector with ``mode`` and
    carries ``run_id`` as a column: the target must be keyed by it, or drop the run's rows before
    the write, for a repeated run to replace them.
    """
    if fmt in FILE_FORMATS:
        df.write.format(fmt).options(**options).mode("overwrite").save(f"{target}/run_id={run_id}")
        return
    marked = df.withColumn("run_id", F.lit(run_id))
    marked.write.format(fmt).options(**options).mode(mode).save(target)


def show(df: DataFrame, n: int = 1) -> None:
    """Prints the first ``n`` rows, one column per line; for a stream, drains it to the console."""
    if df.isStreaming:
        writer = df.writeStream.format("console").option("truncate", False).option("numRows", n)
        writer.trigger(availableNow=True).start().awaitTermination()
        return
    df.show(n, vertical=True, truncate=False)
