import duckdb
import pytest

from basketlab.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    con.execute(f"create view expected as {catalog.ORACLE_SQL[name]}")
    expected = con.execute("select * from expected")
    columns = [c[0] for c in expected.description]
    want = sorted(map(str, expected.fetchall()))
    got = catalog.QUERIES[name](spark, d)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == want
