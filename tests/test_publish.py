"""Publishing as one, stored order, tolerant documents, bucketed hand-over."""

import json

import pytest
from pyspark.sql import functions as F

from basketlab.operators.report import portfolio_detail
from basketlab.sinks.publish import Run, read_published
from basketlab.sinks.writers import read_in_order, write_csv, write_table
from basketlab.sources import fixtures as X
from basketlab.sources.prices import read_price_records
from helpers import SF_SMALL


def test_a_run_that_fails_between_the_writes_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}"
    with pytest.raises(ValueError, match="never published"):
        read_published(spark, root, "Portfolios")
    for k in (1, 2):
        run = Run(spark, root)
        run.write("Portfolios", spark.range(k))
        run.write("PortfoliosDetail", spark.range(10 * k))
        run.commit()
    broken = Run(spark, root)
    broken.write("Portfolios", spark.range(3))
    with pytest.raises(Exception, match="lost"):
        broken.write("PortfoliosDetail", spark.range(30).select(F.raise_error(F.lit("lost")).alias("id")))
    assert read_published(spark, root, "Portfolios").count() == 2
    assert read_published(spark, root, "PortfoliosDetail").count() == 20
    with pytest.raises(ValueError, match="never published"):
        read_published(spark, root, "Other")


def test_stored_order_has_positions_across_files(spark, tmp_path):
    df = spark.range(5000).select(F.concat(F.lit("Portfolio"), F.pmod(F.xxhash64("id"), F.lit(700))).alias("Names"), "id")
    write_table(df.repartition(6).repartitionByRange(5, "Names", "id").sortWithinPartitions("Names", "id"), str(tmp_path / "t"))
    rows = sorted(read_in_order(spark, str(tmp_path / "t")).collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(1, 5001))
    assert [(r.Names, r.id) for r in rows] == sorted((r.Names, r.id) for r in rows)


def test_bad_documents_change_no_other(spark, tmp_path):
    docs = {
        "A": json.dumps({"symbol": "A", "historical": [{"date": "2024-01-02", "adjClose": 10, "label": "x", "volume": 5}, {"date": "2024-01-03", "adjClose": 1.25, "volume": "many"}]}, indent=2),
        "B": json.dumps({"symbol": "B", "historical": [{"date": "2024-01-02", "adjClose": "12.5", "deep": {"a": [1]}}, {"date": 20240103, "adjClose": "none"}, None, 7]}),
        "C": '{"symbol": "C", "historical": [{"date": "2024-',
        "D": "",
        "E": '{"Error Message": "Limit reached"}',
        "F": '{"symbol": "F", "historical": "none"}',
        "G": '{"symbol": "G", "historical": []}',
        "H": "{}",
        "I": "[1, 2]",
    }
    for k, text in docs.items():
        (tmp_path / f"{k}.json").write_text(text)
    df = read_price_records(spark, str(tmp_path))
    rows = {(r.symbol, r.date): r for r in df.collect()}
    assert {k: r.adjClose for k, r in rows.items()} == {
        ("A", "2024-01-02"): 10.0, ("A", "2024-01-03"): 1.25, ("B", "2024-01-02"): 12.5, ("B", "20240103"): None, ("B", None): None,
    }
    assert dict(df.dtypes)["adjClose"] == "double" and rows[("A", "2024-01-02")].label == "x"
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "x.json").write_text("oops")
    assert read_price_records(spark, str(empty)).columns == ["symbol", "date", "adjClose", "label"]


def test_detail_reads_a_bucketed_history_without_a_shuffle(spark, tmp_path):
    name, threshold = "basketlab_test_history", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    write_table(X.stocks_table(spark, SF_SMALL), name, bucket_by="symbol", buckets=4, location=str(tmp_path / "history"))
    held = spark.createDataFrame([("P1", "Brand#1"), ("P2", "Brand#1")], "Names string, Portfolios string")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        detail = portfolio_detail(held, spark.table(name))
        plan = detail._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "hashpartitioning(Portfolios" in plan  # the holdings only
        assert detail.count() == 2 * spark.table(name).where("symbol = 'Brand#1'").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_single_csv_is_joined_from_parallel_parts_in_order(spark, tmp_path):
    path = f"{tmp_path}/report"
    rows = spark.range(5000).select("id", F.concat(F.lit('say "a, b" '), "id").alias("na,me"), F.array("id", "id").alias("pair"))
    stages = spark.sparkContext.statusTracker()
    for df, n in ((rows.repartition(5), 5000), (rows.repartitionByRange(7, "id").sortWithinPartitions("id"), 5000), (rows.limit(0), 0), (rows.where("id < 3").repartitionByRange(7, "id"), 3)):
        spark.sparkContext.setJobGroup("joined", "one file")
        write_csv(df, path, single_file=True)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        files = [f.name for f in (tmp_path / "report").iterdir() if not f.name.startswith(("_", "."))]
        assert files == ["part-00000.csv"] and [f.name for f in tmp_path.iterdir()] == ["report"]
        back = spark.read.option("header", True).option("escape", "\\").csv(path)
        assert back.columns == ["id", "na,me", "pair"] and back.count() == n
        got = [tuple(r) for r in back.collect()]
        assert sorted(got) == sorted((str(r.id), r["na,me"], f"[{r.id}, {r.id}]") for r in df.collect())
        if df.rdd.getNumPartitions() == 7:
            assert [int(g[0]) for g in got] == list(range(n))
    tasks = [stages.getStageInfo(s).numTasks for j in stages.getJobIdsForGroup("joined") for s in stages.getJobInfo(j).stageIds if stages.getStageInfo(s)]
    assert max(tasks) >= 7
    with pytest.raises(FileExistsError):
        write_csv(rows, path, single_file=True, mode="errorifexists")


def test_a_failed_single_csv_leaves_the_old_one(spark, tmp_path):
    path = f"{tmp_path}/report"
    write_csv(spark.range(10), path, single_file=True)
    with pytest.raises(Exception, match="lost"):
        write_csv(spark.range(30).select(F.raise_error(F.lit("lost")).cast("long").alias("id")), path, single_file=True)
    assert spark.read.option("header", True).csv(path).count() == 10 and [f.name for f in tmp_path.iterdir()] == ["report"]
