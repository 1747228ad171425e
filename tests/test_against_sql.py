"""Every registered query against its SQL, computed by another engine."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from ontime.catalog import ORACLE, QUERIES

SPARK_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def other_engine(oracle_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{oracle_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows, columns):
    by_name = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in by_name) for row in rows), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLE.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_result(name, spark, oracle_dir, other_engine):
    df = contract.queries()[name](spark, oracle_dir)
    expected = other_engine.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {c: SPARK_TYPES[t] for c, t in df.dtypes} == types
    rows = ordered([tuple(row) for row in df.collect()], df.columns)
    assert rows, "nothing to compare"
    assert rows == ordered(expected.fetchall(), expected.columns)


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "month",
        "carrier",
        "dep_delay_mean",
        "dep_delay_min",
        "dep_delay_max",
        "cancellation_rate",
    ]
    assert df.count() == 8
