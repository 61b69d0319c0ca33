"""Every registered query against its SQL, as multisets of rows."""

import math
from collections import Counter
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SLOW_PATHS = {"stream_equals_batch"}  # covered again, on a fixture, in test_scoring


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW_PATHS))
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR)
    rows = got.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    expected = duck.sql(sql)
    assert sorted(got.columns) == sorted(expected.columns)
    assert multiset(got.columns, rows) == multiset(expected.columns, expected.fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_has_rows_and_a_fixed_schema(spark):
    result = entry.entry(spark)
    assert result.columns == ["date", "event_type", "cumulative"]
    assert result.count() == 31 * 5
