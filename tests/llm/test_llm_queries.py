"""The corpus queries against their SQL, or against brute force, on the small tables."""

import os

import duckdb
import pytest

from check import TABLES, compare
from driftline.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not there")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    note, _, good = compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR)
    assert good, note
