"""Every registered query against its SQL on the driver's tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry
from seqlog.catalog.oracle import ORACLE
from seqlog.catalog.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    bag = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(bag, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    result = duck.execute(ORACLE[name])
    expected = normal([d[0] for d in result.description], result.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert got[1] == expected[1]
    assert got[1], "query is empty"


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry_is_not_empty(spark):
    assert entry(spark).count() > 0
