"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankstream import schemas
from rankstream.session import fresh_folder, shared_folder
from rankstream.sinks import folders

# Shuffle files of a query that has ended are of no use once its result is stored.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside drop their shuffle files when they end."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def settle(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Cuts the lineage, survives lost executors, and gives the planner the true size, so that it
    broadcasts what is small and shuffles what is not. The disk of its shuffles is free afterwards.
    """
    return _stored(df, fresh_folder(df.sparkSession, f"llm-{label}"))


def _stored(df: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def working(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a :func:`settle` whose tables are dropped at the end: for steps towards one result."""
    made: list[str] = []

    def stage(df: DataFrame, label: str) -> DataFrame:
        made.append(fresh_folder(spark, f"llm-{label}"))
        return _stored(df, made[-1])

    try:
        yield stage
    finally:
        for folder in made:
            folders.drop(spark, folder)


def unsized(df: DataFrame) -> DataFrame:
    """The frame as a join's side whose size the planner cannot tell, so that it is never broadcast.

    The planner takes an exploded array for one row, and a stored table for the size of its compressed files.
    """
    return df.hint("merge")


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, in the shared folder also where the cluster names none."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(df.sparkSession)}/checkpoints")
    return df.checkpoint()


def arrow_type(kind: T.DataType) -> pa.DataType:
    """The Arrow type of the Spark types that the operators return."""
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    plain = {
        schemas.LONG: pa.int64(), schemas.INT: pa.int32(), schemas.DOUBLE: pa.float64(),
        schemas.STRING: pa.string(), schemas.BOOLEAN: pa.bool_(),
    }
    return plain[kind]


def per_value(
    fn: Callable, kind: T.DataType, once: bool = False
) -> Callable[[Column], Column]:
    """A column function that calls ``fn`` on one value at a time.

    Of a batch's texts only one is a Python object at any time, which bounds a worker's memory.
    ``once`` keeps the planner from calling it anew for each filter on its result.
    """
    made = arrow_type(kind)

    def column(value: Column) -> Column:
        @F.arrow_udf(kind)
        def applied(values: pa.Array) -> pa.Array:
            return pa.array((fn(v.as_py()) for v in values), type=made)

        return (applied.asNondeterministic() if once else applied)(value)

    return column


def hidden(label: str) -> str:
    """A column name that no input has."""
    return f"_{label}_{uuid.uuid4().hex[:8]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row; equal rows share them, nulls count as values."""
    columns = [F.col(f"`{name}`") for name in df.columns]
    return [F.xxhash64(F.lit(salt), *columns) for salt in ("a", "b")]
