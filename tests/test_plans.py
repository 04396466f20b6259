"""Physical-plan checks: pruning, pushdown and no single-partition exchange over raw data."""

from basketlab.plans.catalog import analysis
from basketlab.sources import fixtures as X
from helpers import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_input_scan_reads_four_columns_and_aggregates_partially(spark):
    plan = _plan(X.brand_sums(spark, SF_SMALL))
    assert "struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    assert "partial_sum" in plan
    assert "SinglePartition" not in plan


def test_single_partition_only_over_calendar_and_scalars(spark):
    a = analysis(spark, SF_SMALL, materialize_stages=False)
    plan = a.returns._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            # the child of a single-partition exchange is the distinct calendar or a scalar count
            below = "\n".join(lines[i + 1 : i + 4])
            assert "Project [date" in below or "partial_count" in below, below


def test_correlation_forms_no_per_date_pairs(spark):
    a = analysis(spark, SF_SMALL)
    plan = _plan(a.corr)
    assert "FlatMapGroupsInPandas" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_returns_take_one_window_by_symbol_and_no_panel_self_join(spark):
    from basketlab.operators.panel import calendar, return_cells

    a = analysis(spark, SF_SMALL)
    plan = _plan(return_cells(a.panel, calendar(a.panel, a.index)))
    assert "lead(price" in plan and plan.count("price#") > 0
    assert not [x for x in plan.splitlines() if "Join [date" in x and "symbol" in x.split("Join")[1][:60]]


def test_no_cross_or_nested_loop_join_in_any_stage(spark):
    a = analysis(spark, SF_SMALL, optimal=True, materialize_stages=False)
    stages = ["panel", "index", "returns", "corr", "peers", "baskets", "members", "means", "cov", "betas",
              "latest", "equal_weights", "optimal_weights", "risk", "expected_return", "summary", "holdings", "detail"]
    for name in stages:
        plan = _plan(getattr(a, name))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_bucketed_stocks_table_aggregates_without_shuffle(spark):
    from basketlab.operators.panel import price_panel
    from basketlab.sinks.writers import write_table

    name = "basketlab_test_bucketed_stocks"
    write_table(X.stocks_table(spark, SF_SMALL), name, bucket_by="symbol", buckets=4)
    try:
        plan = _plan(price_panel(spark.table(name)))
        assert "Exchange" not in plan, plan
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
