"""Every registered query against its SQL twin on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def duck(medium):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{medium}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((value is not None, str(value)) for value in row))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, medium, name):
    ours = QUERIES[name](spark, medium)
    cursor = duck.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    assert sorted(ours.columns) == sorted(columns)
    got = _rows(ours.columns, [tuple(row) for row in ours.collect()])
    want = _rows(columns, expected)
    assert len(got) == len(want)
    for left, right in zip(got, want):
        assert left == right
        assert [type(value) for value in left] == [type(value) for value in right]


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
