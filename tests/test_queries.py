"""Every registered query with SQL gives DuckDB's result on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from marlstone.plans import aggregate_queries, join_queries, metric_queries, registry_queries, rule_queries, scalar_queries, scale_queries  # noqa: F401
from marlstone.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"{value.normalize():f}" if value else "0"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())
    assert rows == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
