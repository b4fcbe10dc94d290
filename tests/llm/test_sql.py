"""Queries that SQL can express against their SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from inkgrid.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_counterpart(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    got, want = queries.QUERIES[name](spark, DATA), con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
