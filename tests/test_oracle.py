"""Every registered query against the same query in SQL, on whole tables at sf0.01."""

import math
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from ringlake.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    ours = _bag(df.columns, df.collect())
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    theirs = _bag(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert ours, "no rows"
    assert ours == theirs
