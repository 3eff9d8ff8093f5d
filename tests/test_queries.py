"""Every registered query against its SQL on the smallest tables."""

import pytest
from check_queries import compare, connect
from conftest import DATA

import __spark_entry__
from tideload.queries import ORACLES, QUERIES
from tideload.queries.registry import clear_query_data

FOLDER = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    found = compare(spark, con, name, FOLDER)
    clear_query_data(spark)
    assert found == []
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith("tideload_")]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
