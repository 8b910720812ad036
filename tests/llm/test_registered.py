from __future__ import annotations

import duckdb
import pytest

from headway.llm.queries import ORACLE, QUERIES
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_duckdb(spark, name):
    found = QUERIES[name](spark, DATA)
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    columns = sorted(found.columns)
    expected = connection.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(str, found.select(*columns).collect())) == sorted(
        _shown(columns, row) for row in expected
    )


def _shown(columns: list[str], values: tuple) -> str:
    return "Row(" + ", ".join(f"{c}={v!r}" for c, v in zip(columns, values)) + ")"
