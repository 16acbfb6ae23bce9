"""Every core query gives the rows of its DuckDB oracle: names, types and values."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from quirework.plans import catalog

KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, small, duck, name):
    df = catalog.queries()[name](spark, small)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    if name not in catalog.oracle_sql():
        assert got
        return
    result = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert {n: str(d[1]) for n, d in zip(names, result.description)} == {c: KINDS[t] for c, t in df.dtypes}
    at = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(row[i] for i in at)) for row in result.fetchall())
