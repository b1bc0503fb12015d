"""Stream readers; everything downstream is the same whichever one is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def kafka_topic(spark: SparkSession, topic: str, brokers: str, **options: str) -> DataFrame:
    """One Kafka topic; needs the spark-sql-kafka package on the classpath."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
    return reader.option("subscribe", topic).options(**options).load()


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files of a folder as a stream.

    Over the folder of an append sink the sink's own log lists the files, so a chained stream
    sees each committed row once. ``maxBytesPerTrigger`` bounds a micro-batch.
    """
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)
