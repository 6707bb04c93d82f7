"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from firstseen.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    named = [d[0] for d in cursor.description]
    assert sorted(named) == columns
    order = [named.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    found = [tuple(row[c] for c in columns) for row in frame.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
