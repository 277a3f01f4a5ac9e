"""Every registered query against the same result computed by DuckDB from its SQL twin."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb
import pytest

from tidemark.plans.catalog import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = catalogue()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, duck):
    query = QUERIES[name]
    assert query.sql is not None
    result = query.build(spark, FOLDER)
    columns = sorted(result.columns)
    ours = Counter(tuple(plain(row[c]) for c in columns) for row in result.collect())
    answer = duck.execute(query.sql)
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in answer.fetchall())
    assert ours == theirs
