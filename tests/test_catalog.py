"""Every registered query against its SQL counterpart in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from brindle.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE  # the optional subpackage has tests of its own

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in result.collect()]
    if name not in ORACLE:
        assert rows
        return
    expected = duck.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert _comparable(result.columns, rows) == _comparable(columns, expected.fetchall())


def test_oracle_names_are_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert 0 < entry_points.entry(spark).count() <= 20
