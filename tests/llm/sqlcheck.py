"""Compares a query with its SQL in DuckDB, on files or on given rows."""

from __future__ import annotations

import duckdb

from rinse.llm import queries


def rows_of(table):
    names = sorted(table.column_names)
    return names, sorted(zip(*[table.column(n).to_pylist() for n in names]), key=repr)


def same_as_sql(spark, name, folder, tables):
    duck = duckdb.connect()
    for x in tables:
        path = f"{folder}/{x}.parquet"
        duck.execute(f"create view {x} as select * from read_parquet('{path}{'/*.parquet' if not path.startswith('/root') else ''}')")
    ours = queries.QUERIES[name](spark, str(folder)).toArrow()
    theirs = duck.execute(queries.SQL[name]).to_arrow_table()
    assert rows_of(ours) == rows_of(theirs)
    return ours
