"""Where working files go."""

from types import SimpleNamespace

from rankstream.session import DEFAULTS, fresh_folder, shared_folder


def session(folder=None, warehouse="file:/lake/warehouse"):
    known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": warehouse}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: known[key] or default))


def test_the_cluster_names_the_folder():
    assert shared_folder(session("hdfs:///shared/")) == "hdfs:///shared"
    assert fresh_folder(session("hdfs:///shared/"), "x").startswith("hdfs:///shared/")


def test_else_it_lies_in_the_warehouse():
    assert shared_folder(session()) == "file:/lake/warehouse/_work"


def test_defaults_are_in_force(spark):
    assert {k: spark.conf.get(k) for k in DEFAULTS} == DEFAULTS
