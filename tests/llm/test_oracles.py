"""Corpus queries that SQL can express, against their SQL over whole tables."""

import pytest
from compare import spark_bag, sql_bag, sql_connection

from rankstream.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, sf_dir, name):
    columns, found = spark_bag(catalog.QUERIES[name](spark, sf_dir))
    expected_columns, expected = sql_bag(sql_connection(sf_dir), catalog.SQL[name])
    assert columns == expected_columns
    assert found == expected
