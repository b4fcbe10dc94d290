"""Every query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from inkgrid.plans import catalog, catalog_runs, catalog_values, registry  # noqa: F401

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(x[i] for i in order) for x in data), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA)
    data = [tuple(r) for r in got.collect()]
    if name not in registry.ORACLES:
        assert got.columns and data
        return
    want = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, data) == rows(names, want.fetchall())
