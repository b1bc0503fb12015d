"""Batch readers over a landing folder of JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankstream import schemas
from rankstream.functions.keys import stable_id
from rankstream.operators.nested import inline_array

CORRUPT = "_corrupt_record"

# Fixed value of the league feed.
QUEUE_TYPE = "RANKED_TFT"


def read_json(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """JSON under a declared schema; an unreadable record keeps its text in ``_corrupt_record``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(with_corrupt).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).options(**options).json(path)


def readable(df: DataFrame) -> DataFrame:
    """Records that could be read, without the corrupt-text column."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_catalogue(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The entries of a multi-line catalogue document: one row per element of its array."""
    document = read_json(spark, path, schemas.CATALOGUES[kind], multiLine="true")
    return inline_array(readable(document), kind)


def read_league_entries(spark: SparkSession, path: str) -> DataFrame:
    """League entries, one JSON object per line."""
    return readable(read_json(spark, path, schemas.LEAGUE_ENTRY))


def queue_players(entries: DataFrame, queue_type: str = QUEUE_TYPE) -> DataFrame:
    """Entries of the ranked queue as unprocessed work, each with an id that never changes."""
    return (
        entries.filter(F.col("queueType") == queue_type)
        .withColumn("idx", stable_id("puuid", "queueType"))
        .withColumn("processedTime", F.lit(None).cast("timestamp"))
    )


def read_match_documents(spark: SparkSession, path: str) -> DataFrame:
    """Match documents, one per line, all files of the folder in one scan."""
    return readable(read_json(spark, path, schemas.MATCH_DOCUMENT))
