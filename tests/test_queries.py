"""Every registered query against its SQL twin over whole tables."""

import pytest

import __spark_entry__ as contract
from compare import spark_bag, sql_bag, sql_connection

from rankstream.plans.catalog import QUERIES
from rankstream.plans.oracle import SQL


@pytest.fixture(scope="module")
def connection(sf_dir):
    return sql_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, connection, name):
    columns, found = spark_bag(QUERIES[name](spark, sf_dir))
    assert found
    expected_columns, expected = sql_bag(connection, SQL[name])
    assert columns == expected_columns
    assert found == expected


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys() and SQL.keys() <= contract.oracle_sql().keys()


def _bytes(folder):
    return sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())


def test_a_second_run_leaves_no_more_data(spark, sf_dir):
    from pathlib import Path

    from rankstream.session import shared_folder

    root = Path(shared_folder(spark).removeprefix("file:")) / "rankstream" / "queries"
    for name in ("write_or_upsert", "stream_append", "json_inline"):
        sizes = []
        for _ in range(2):
            QUERIES[name](spark, sf_dir).count()
            sizes.append(_bytes(root))
        assert sizes[0] == pytest.approx(sizes[1], rel=0.01)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[:3] == ["trait1", "trait2", "strength"]
    assert result.count() >= 25
