"""Spark results against DuckDB, as multisets of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

KINDS = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(folder: str, tables) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def assert_same(df, con, sql: str) -> int:
    names = sorted(df.columns)
    ours = Counter(tuple(row) for row in df.select(*names).collect())
    cursor = con.execute(sql)
    columns = {column[0]: (place, str(column[1])) for place, column in enumerate(cursor.description)}
    assert sorted(columns) == names
    kinds = {name: KINDS[df.schema[name].dataType.simpleString()] for name in names}
    assert kinds == {name: columns[name][1] for name in names}
    places = [columns[name][0] for name in names]
    theirs = Counter(tuple(row[place] for place in places) for row in cursor.fetchall())
    assert list((ours - theirs).items())[:3] == [] == list((theirs - ours).items())[:3]
    return sum(ours.values())
