"""Round trips: JSON documents, CSV index and companies, snapshots, repeated delivery."""

import datetime as dt
import json
import os

import pytest

from basketlab.sinks.writers import write_csv, write_snapshot
from basketlab.sources.index import index_series, read_csv_text
from basketlab.sources.prices import flatten_history, read_price_documents


def _write(path, obj):
    with open(path, "w") as f:
        json.dump(obj, f, indent=2)


def test_json_documents(spark, tmp_path):
    d = tmp_path / "docs"
    d.mkdir()
    _write(d / "A.json", {"symbol": "A", "historical": [
        {"date": "2024-01-02", "adjClose": 10, "label": "Jan 02", "volume": 5},
        {"date": "2024-01-03", "adjClose": 11.5, "label": "Jan 03", "volume": 6}]})
    _write(d / "B.json", {"symbol": "B", "historical": [{"date": "2024-01-02", "adjClose": 3}]})
    _write(d / "C.json", {"Error Message": "Limit reached"})
    _write(d / "D.json", {})
    _write(d / "E.json", {"symbol": "E", "historical": []})
    flat = flatten_history(read_price_documents(spark, str(d)))
    rows = sorted(flat.collect(), key=lambda r: (r["symbol"], r["date"]))
    assert [(r["symbol"], r["date"], r["adjClose"]) for r in rows] == [
        ("A", "2024-01-02", 10.0), ("A", "2024-01-03", 11.5), ("B", "2024-01-02", 3.0)]
    assert rows[2]["label"] is None and rows[0]["volume"] == 5
    assert dict(flat.dtypes)["adjClose"] == "double"


def test_index_text_parsing(spark, ansi):
    raw = spark.createDataFrame(
        [("01/05/2024", "4700.5", "x"), ("1/6/2024", "4701", "x"), ("bad", "1", "x"),
         ("01/07/24", "1", "x"), ("01/08/2024", "5,123.5", "x"), ("01/09/2024", "1", None)],
        "Date string, Close string, Other string")
    got = {r["date"]: r["level"] for r in index_series(raw).collect()}
    # '5,123.5' is present but not a number: the date stays, with a missing level
    assert got == {dt.date(2024, 1, 5): 4700.5, dt.date(2024, 1, 6): 4701.0, dt.date(2024, 1, 8): None}


def test_csv_round_trip(spark, tmp_path):
    p = tmp_path / "SP500.csv"
    p.write_text("Date,Open,Close\n01/05/2024,1,4700.5\n1/8/2024,2,4710\n")
    got = index_series(read_csv_text(spark, str(p))).orderBy("date").collect()
    assert [(r["date"], r["level"]) for r in got] == [(dt.date(2024, 1, 5), 4700.5), (dt.date(2024, 1, 8), 4710.0)]


def test_single_csv_with_arrays(spark, tmp_path):
    df = spark.createDataFrame([("P1", ["A", "B"], 1.5)], "Names string, Portfolios array<string>, v double")
    out = tmp_path / "csv"
    write_csv(df, str(out), single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    text = (out / parts[0]).read_text()
    assert text.splitlines()[0] == "Names,Portfolios,v" and "[A, B]" in text


def test_snapshot_rerun_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "snap")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    write_snapshot(df, out, "2024-01-01")
    write_snapshot(df, out, "2024-01-02")
    write_snapshot(df, out, "2024-01-01")
    back = spark.read.parquet(out)
    assert back.count() == 4
    assert sorted(str(r[0]) for r in back.select("run_date").distinct().collect()) == ["2024-01-01", "2024-01-02"]


def test_second_delivery_of_the_full_history_replaces_the_first(spark, tmp_path):
    from basketlab.operators.panel import price_panel
    from basketlab.plans.pipeline import upload_prices

    docs, target = tmp_path / "in", str(tmp_path / "stocks")
    docs.mkdir()
    first = [{"date": "2024-01-02", "adjClose": 10.0, "label": "a"}]
    _write(docs / "A.json", {"symbol": "A", "historical": first})
    upload_prices(spark, str(docs), target)
    _write(docs / "A.json", {"symbol": "A", "historical": [*first, {"date": "2024-01-03", "adjClose": 11.0, "label": "b"}]})
    upload_prices(spark, str(docs), target)
    panel = {str(r["date"]): r["price"] for r in price_panel(spark.read.parquet(target)).collect()}
    assert panel == {"2024-01-02": 10.0, "2024-01-03": 11.0}


def test_repeated_index_date_counts_once_with_its_highest_level(spark):
    raw = spark.createDataFrame([("01/02/2024", "5"), ("1/2/2024", "7.5"), ("01/02/2024", "bad"), ("01/03/2024", "bad")], "Date string, Close string")
    assert {str(r["date"]): r["level"] for r in index_series(raw).collect()} == {"2024-01-02": 7.5, "2024-01-03": None}
