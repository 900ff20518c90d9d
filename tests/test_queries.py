"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    return con


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([comparable(row[i]) for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    got = rows_of(df.columns, df.collect())
    assert got
    if sql is not None:
        answer = duck.sql(sql)
        assert sorted(answer.columns) == sorted(df.columns)
        want = rows_of(answer.columns, answer.fetchall())
        assert len(got) == len(want)
        assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
