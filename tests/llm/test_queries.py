"""The registered queries against their SQL, on the smallest tables and on odd ones."""

import os

import pytest

from estrato.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


def compare(spark, name, folder):
    con = duckdb.connect()
    for table in os.listdir(folder):
        if table.endswith(".parquet"):
            path = f"{folder}/{table}" + ("/*.parquet" if os.path.isdir(f"{folder}/{table}") else "")
            con.execute(f"create view {table.removesuffix('.parquet')} as select * from '{path}'")
    df = QUERIES[name](spark, folder)
    names = sorted(df.columns)
    result = con.execute(ORACLES[name])
    order = [[d[0] for d in result.description].index(n) for n in names]
    text = lambda rows: sorted(tuple("" if v is None else repr(v) for v in r) for r in rows)
    assert text(df.select(*names).collect()) == text([[r[i] for i in order] for r in result.fetchall()])


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    compare(spark, name, SF)


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_licenses"])
def test_odd_documents(spark, docs, tmp_path, name):
    notices = spark.createDataFrame([(5000, "A Released\tunder the MIT License, x\nApache  license; CC-BY", "e", "s", 1),
                                     (5001, "licensed Under the gnu general public\nLICENSE version 3 gnu-general public  license", "e", "s", 1),
                                     (5002, "mit\nlicense mit license mit license Kind", "e", "s", 1)], docs.schema)
    docs.union(notices).write.parquet(f"{tmp_path}/documents.parquet")
    compare(spark, name, str(tmp_path))


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
