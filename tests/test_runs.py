"""The run sink: repeated and failed writes leave one whole copy."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rankstream.sinks.runs import write_run


def left_over(target):
    work = os.path.join(target, "_writing")
    return os.listdir(work) if os.path.exists(work) else []


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    target = str(tmp_path / "out")
    data = spark.range(1000).repartition(4).withColumn("x", F.col("id") * 2)
    for df in (data, data, data.filter("id < 10")):
        write_run(df, target, "a")
    write_run(data, target, "b")
    read = spark.read.parquet(target)
    assert read.filter("run_id = 'a'").count() == 10
    assert rows(read.filter("run_id = 'b'"), "id", "x") == rows(data)
    assert left_over(target) == []


def test_a_failed_run_leaves_what_was(spark, tmp_path):
    target = str(tmp_path / "out")
    write_run(spark.range(10), target, "a")
    broken = spark.range(100).repartition(4).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id")
    )
    for run in ("a", "c"):
        with pytest.raises(Exception, match="broken"):
            write_run(broken, target, run)
    assert rows(spark.read.parquet(target), "id", "run_id") == sorted([(i, "a") for i in range(10)], key=repr)
    assert left_over(target) == []


def test_empty_runs_and_names(spark, tmp_path):
    target = (tmp_path / "out").as_uri()
    write_run(spark.range(3), target, "a")
    write_run(spark.range(0), target, "a")
    assert os.listdir(tmp_path / "out" / "run_id=a") == []
    for bad in ("", "a/b"):
        with pytest.raises(Exception):
            write_run(spark.range(1), target, bad)
