"""Every named query against its SQL, on the smallest tables."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, (bool, np.bool_)):
        return str(bool(value))
    return repr(float(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=str)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, database, name):
    df = contract.queries()[name](spark, SF_DIR)
    got = df.collect()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = database.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(columns, result.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["term", "count"] and df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
