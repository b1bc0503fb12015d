"""Log records on the wire: a 5-byte registry header, then the payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankstream import schemas

HEADER_BYTES = 5
_CORRUPT = "_corrupt_record"


def strip_header(value: Column, size: int = HEADER_BYTES) -> Column:
    """The payload bytes after the header."""
    return F.substring(value, F.lit(size + 1), F.length(value) - size)


def _decode_avro(payload: Column, schema: str) -> Column:
    from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package

    return from_avro(payload, schema, {"mode": "PERMISSIVE"})


def _decode_json(payload: Column, schema: T.StructType) -> Column:
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_json(payload.cast("string"), with_corrupt, options)


def decode(df: DataFrame, fmt: str = "json", avro_schema: str | None = None) -> DataFrame:
    """Binary ``value`` column to the log record's columns.

    A field the payload lacks takes its default; an undecodable payload gives a row of nulls.
    """
    payload = strip_header(F.col("value"))
    if fmt == "avro":
        schema = avro_schema or schemas.avro_record_schema()
        return df.select(_decode_avro(payload, schema).alias("record")).select("record.*")
    if fmt != "json":
        raise ValueError(f"unknown record format {fmt!r}")
    record = df.select(_decode_json(payload, schemas.LOG_RECORD).alias("record"))
    # an unreadable payload has its text in the corrupt field; a null payload has a null record
    decoded = F.col("record").isNotNull() & F.col(f"record.{_CORRUPT}").isNull()
    return record.select(
        *[
            F.when(
                decoded,
                F.coalesce(F.col(f"record.{f.name}"), F.lit(schemas.LOG_RECORD_DEFAULTS[f.name])),
            ).alias(f.name)
            for f in schemas.LOG_RECORD.fields
        ]
    )


def decode_flagged(df: DataFrame) -> DataFrame:
    """JSON records with the raw ``value``, ``unread`` and ``defaulted``.

    ``unread`` marks payloads that cannot be decoded, null ones included; ``defaulted`` counts the
    fields that the payload lacks.
    """
    payload = strip_header(F.col("value"))
    read = df.select("value", _decode_json(payload, schemas.LOG_RECORD).alias("record"))
    unread = F.col("record").isNull() | F.col(f"record.{_CORRUPT}").isNotNull()
    lacking = [F.col(f"record.{f.name}").isNull().cast("int") for f in schemas.LOG_RECORD.fields]
    fields = [
        F.coalesce(F.col(f"record.{f.name}"), F.lit(schemas.LOG_RECORD_DEFAULTS[f.name])).alias(f.name)
        for f in schemas.LOG_RECORD.fields
    ]
    return read.select("value", unread.alias("unread"), sum(lacking).alias("defaulted"), *fields)


def encode(df: DataFrame, header: bytes = bytes(HEADER_BYTES)) -> DataFrame:
    """Log record columns to the JSON wire form: one binary ``value`` column."""
    body = F.to_json(F.struct(*[f.name for f in schemas.LOG_RECORD.fields])).cast("binary")
    return df.select(F.concat(F.lit(header), body).alias("value"))
