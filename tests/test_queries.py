"""Every registered query against its SQL on the smallest test tables."""

import datetime

import duckdb
import pytest

import __spark_entry__ as entry_points
from sluiceway.registry import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def canonical_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, sf_dir):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    found = [tuple(row) for row in df.collect()]
    result = duck.execute(SQL[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = result.fetchall()
    assert expected, "the SQL returns nothing to compare"
    assert canonical_rows(df.columns, found) == canonical_rows(names, expected)
