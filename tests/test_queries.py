"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare
from driftline.plans.catalog import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not there")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries())
    assert set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    note, _, good = compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR)
    assert good, note


def test_entry(spark):
    assert entry(spark).columns == ["year", "month", "total_uncommon_words"]
