"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from checks import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


def cells(rows):
    return sorted(tuple("" if v is None else repr(v) if isinstance(v, float) else str(v) for v in r)
                  for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    result = db.execute(ORACLES[name])
    shown = [d[0] for d in result.description]
    assert sorted(shown) == names
    order = [shown.index(n) for n in names]
    want = cells([[r[i] for i in order] for r in result.fetchall()])
    got = cells(df.select(*[f"`{n}`" for n in names]).collect())
    assert got == want
    assert got


def test_all_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
