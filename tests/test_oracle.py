"""Every registered query with SQL against DuckDB, on the smallest provided tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tickerloom.catalog.queries import REGISTERED

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no provided tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def settled(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    want = duck.sql(oracle_sql()[name])
    assert settled(df.columns, df.collect()) == settled(want.columns, want.fetchall())


def test_every_sql_has_a_query_and_only_open_ended_queries_lack_sql():
    assert set(oracle_sql()) <= set(queries())
    assert set(REGISTERED) - set(oracle_sql()) == {"sample_rows"}


def test_entry(spark):
    assert entry(spark).count() > 0
