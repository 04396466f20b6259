"""End to end: JSON documents and CSV files -> upload -> pipeline -> tables and CSV."""

import json

from pyspark.sql import functions as F

from basketlab.config import TEST_CONFIG
from basketlab.plans import catalog
from basketlab.plans.pipeline import run_pipeline, upload_prices
from basketlab.sources import fixtures as X
from helpers import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_files_round_trip_equals_in_memory_analysis(spark, tmp_path):
    docs_dir = tmp_path / "docs"
    docs_dir.mkdir()
    for r in X.price_documents(spark, SF_SMALL).collect():
        doc = {"symbol": r["symbol"], "historical": [h.asDict() for h in r["historical"]]}
        (docs_dir / f"{r['symbol'].replace('#', '_')}.json").write_text(json.dumps(doc, indent=1))
    (docs_dir / "ERR.json").write_text(json.dumps({"Error Message": "bad ticker"}))
    idx_csv, comp_csv = str(tmp_path / "index"), str(tmp_path / "companies")
    X.index_text(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(idx_csv)
    X.companies(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(comp_csv)

    stocks = upload_prices(spark, str(docs_dir), str(tmp_path / "stocks"))
    out = run_pipeline(
        spark,
        str(tmp_path / "stocks"),
        idx_csv,
        comp_csv,
        TEST_CONFIG,
        holdings_target=str(tmp_path / "holdings"),
        detail_target=str(tmp_path / "detail"),
        csv_path=str(tmp_path / "csv"),
        snapshot_path=str(tmp_path / "archive"),
        run_date="2024-01-02",
    )
    ref = catalog.analysis(spark, SF_SMALL, optimal=True)
    assert stocks.count() == ref.stocks.count()
    assert _rows(out.summary) == _rows(ref.summary)
    assert _rows(out.holdings) == _rows(ref.holdings)
    detail = spark.read.parquet(str(tmp_path / "detail"))
    assert detail.count() == ref.detail.count() > 0
    assert "label" not in detail.columns
    csv_back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert csv_back.count() == detail.count()
    snap = spark.read.option("header", True).csv(str(tmp_path / "archive"))
    assert snap.where(F.col("run_date") == "2024-01-02").count() == detail.count()


def test_no_basket_gives_empty_outputs_with_schema(spark):
    from dataclasses import replace

    cfg = replace(TEST_CONFIG, corr_lo=0.995, corr_hi=0.999)
    a = catalog.analysis(spark, SF_SMALL, config=cfg, optimal=True)
    assert a.baskets.count() == 0
    for df in (a.summary, a.holdings, a.detail):
        assert df.count() == 0
    assert a.summary.columns == ["Names", "Portfolios", "Weightage", "TotalReturns", "InvestmentAmount", "Volatility"]
    assert dict(a.optimal_weights.dtypes)["weight"] == "float"


def test_cli_upload_and_analyze(spark, tmp_path):
    from basketlab.plans.cli import main

    docs_dir = tmp_path / "docs"
    docs_dir.mkdir()
    for r in X.price_documents(spark, SF_SMALL).collect():
        doc = {"symbol": r["symbol"], "historical": [h.asDict() for h in r["historical"]]}
        (docs_dir / f"{r['symbol'].replace('#', '_')}.json").write_text(json.dumps(doc))
    X.index_text(spark, SF_SMALL).write.option("header", True).csv(str(tmp_path / "index"))
    X.companies(spark, SF_SMALL).write.option("header", True).csv(str(tmp_path / "companies"))
    main(["upload", "--docs", str(docs_dir), "--stocks", str(tmp_path / "stocks")])
    main([
        "analyze", "--stocks", str(tmp_path / "stocks"), "--index", str(tmp_path / "index"),
        "--companies", str(tmp_path / "companies"), "--holdings", str(tmp_path / "holdings"),
        "--detail", str(tmp_path / "detail"), "--corr-lo", "0.2", "--universe", "all", "--archive", str(tmp_path / "archive"),
        "--run-date", "2024-03-01", "--archive-inputs", str(tmp_path / "inputs"),
    ])
    ref = catalog.analysis(spark, SF_SMALL, optimal=True)
    archived = spark.read.parquet(str(tmp_path / "inputs"))
    assert archived.where("run_date = '2024-03-01'").count() == ref.stocks.count()
    assert _rows(spark.read.parquet(str(tmp_path / "holdings"))) == _rows(ref.holdings)


def test_basket_and_summary_invariants(spark):
    a = catalog.analysis(spark, "/root/testdata/sf0.01", optimal=True)
    cfg = TEST_CONFIG
    corr = {(r["symbol_a"], r["symbol_b"]): r["corr"] for r in a.corr.collect()}
    baskets = {}
    for r in a.baskets.collect():
        baskets.setdefault(r["portfolio"], {})[r["pos"]] = r["symbol"]
    k = len(baskets)
    assert k > 0 and set(baskets) == {f"Portfolio{i}" for i in range(1, k + 1)}
    for members in baskets.values():
        n = len(members)
        assert cfg.min_size <= n <= cfg.max_size and sorted(members) == list(range(n))
        seed = members[n - 1]
        for pos in range(n - 1):
            assert cfg.corr_lo <= corr[(members[pos], seed)] <= cfg.corr_hi
    for row in a.summary.collect():
        members = baskets[row["Names"]]
        assert row["Portfolios"] == [members[p] for p in range(len(members))]
        assert len(row["Weightage"]) == len(members) and all(w >= 0 for w in row["Weightage"])
        assert abs(sum(row["Weightage"]) - 1) <= 0.005 * len(members)
