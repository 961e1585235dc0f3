"""Each registered query against its SQL at sf0.01, by rows."""

import os

import duckdb
import pytest

from recordloom.plans import catalog

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DIR):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{DIR}/{name}')")
    con.execute("SET TimeZone = 'UTC'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))
    if name not in catalog.oracle_sql():
        assert got
        return
    rel = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(str(r[i]) for i in order) for r in rel.fetchall())
