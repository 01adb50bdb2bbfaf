"""Every registered query against its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
# Names of the same type in the two engines.
SAME = {"large_string": "string"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=repr)


def _schema(table):
    types = {field.name: str(field.type) for field in table.schema}
    return {name: SAME.get(kind, kind) for name, kind in types.items()}


# tests/llm compares the other queries.
@pytest.mark.parametrize("name", sorted(contract.registry.QUERIES))
def test_same_rows(spark, duck, name):
    ours = contract.queries()[name](spark, FOLDER).toArrow()
    theirs = duck.execute(contract.oracle_sql()[name]).to_arrow_table()
    assert _schema(ours) == _schema(theirs)
    assert ours.num_rows == theirs.num_rows > 0
    assert _rows(ours) == _rows(theirs)


def test_every_query_has_sql():
    assert set(contract.registry.QUERIES) == set(contract.registry.SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
