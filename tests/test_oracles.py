"""Registered queries against their DuckDB oracles on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from basketlab.plans import catalog
from helpers import SF_SMALL

TABLES = ["lineitem", "part"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


ORACLES = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    con.execute(f"CREATE OR REPLACE VIEW expected AS {ORACLES[name]}")  # as a view, like any stored statement
    res = con.execute("SELECT * FROM expected")
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, rows) == _rows(ocols, orows)


def test_every_query_has_an_oracle_and_entry_has_rows(spark):
    assert set(catalog.QUERIES) == set(ORACLES)
    assert set(catalog.QUERIES) <= set(E.queries())
    assert E.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["aligned_returns", "correlation_matrix", "betas", "equal_weight_summary", "weights_kkt_violations"]
)
def test_query_matches_oracle_with_ansi_off(spark, con, name):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        test_query_matches_oracle(spark, con, name)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
