"""Log records to bronze and silver rows; plain projections, the same in batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankstream.functions import requests


def bronze_logs(records: DataFrame) -> DataFrame:
    """Decoded records with the event time as an instant and its UTC date."""
    instant = requests.event_time(F.col("timestamp"))
    return records.withColumn("timestamp", instant).withColumn(
        "date", requests.event_date(F.col("timestamp"))
    )


def silver_logs(bronze: DataFrame) -> DataFrame:
    """Bronze rows with product, price and action in place of the raw path."""
    path = F.col("endpoint_path")
    return (
        bronze.withColumn("product", requests.product(path))
        .withColumn("rp", requests.price(path))
        .withColumn("action", requests.action(path))
        .drop("endpoint_path")
    )
