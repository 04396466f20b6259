"""The daily batch as one Spark application: upload, analysis, report.

``upload_prices``: folder of per-ticker JSON documents -> flat stocks table.
``run_pipeline``: stocks table + index CSV + company CSV -> basket summary,
holdings and detail tables, plus the dashboard CSV. Tables are written only
at the edges; the small reused intermediates live in the shared checkpoint
folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from basketlab.config import PipelineConfig
from basketlab.operators.report import portfolio_detail
from basketlab.plans.analysis import Analysis
from basketlab.session import materialize
from basketlab.sinks.publish import Run
from basketlab.sinks.writers import write_csv, write_snapshot, write_table
from basketlab.sources.index import read_companies, read_csv_text
from basketlab.sources.prices import flatten_history, read_price_documents, read_stocks


def upload_prices(
    spark: SparkSession,
    docs_path: str,
    stocks_target: str,
    schema: StructType | str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """JSON documents -> flat stocks table (overwritten); returns the written table.

    Without ``schema`` the record fields are inferred (unknown fields pass
    through) at the cost of one extra pass over the documents; with
    an explicit schema the scan is single-pass.
    ``buckets`` stores a catalog table bucketed by ``symbol``: the daily price
    panel then aggregates it without a shuffle.
    """
    flat = flatten_history(read_price_documents(spark, docs_path, schema))
    # a multi-line JSON file is one task; a ticker with a huge history would
    # otherwise write its whole share from that task: AQE splits the partition
    write_table(flat.hint("rebalance"), stocks_target, bucket_by="symbol" if buckets else None, buckets=buckets)
    return read_stocks(spark, stocks_target)


def in_order(holdings: DataFrame) -> DataFrame:
    """Holdings by basket name, as text, and by ticker within a basket."""
    return holdings.orderBy("Names", "Portfolios")


@dataclass
class PipelineOutputs:
    analysis: Analysis
    summary: DataFrame
    holdings: DataFrame
    detail: DataFrame


def run_pipeline(
    spark: SparkSession,
    stocks: DataFrame | str,
    index_csv: DataFrame | str,
    companies_csv: DataFrame | str,
    config: PipelineConfig | None = None,
    holdings_target: str | None = None,
    detail_target: str | None = None,
    csv_path: str | None = None,
    csv_single_file: bool = False,
    snapshot_path: str | None = None,
    run_date: str | None = None,
    inputs_archive_path: str | None = None,
    publish_root: str | None = None,
) -> PipelineOutputs:
    """Build (and optionally publish) the basket report.

    ``publish_root`` publishes holdings (``Portfolios``) and detail
    (``PortfoliosDetail``) together: readers see both of one run, or both of the
    run before (``sinks.publish``).

    ``snapshot_path`` keeps one dated partition of the report per run and
    ``inputs_archive_path`` one of the input stocks table; re-running a day
    replaces only that day.
    """
    stocks_df = read_stocks(spark, stocks) if isinstance(stocks, str) else stocks
    index_df = read_csv_text(spark, index_csv) if isinstance(index_csv, str) else index_csv
    comp_df = read_companies(spark, companies_csv) if isinstance(companies_csv, str) else companies_csv
    if inputs_archive_path:
        write_snapshot(stocks_df, inputs_archive_path, run_date)
    a = Analysis(stocks_df, index_df, comp_df, config or PipelineConfig(), optimal=True, materialize_stages=True)
    summary, holdings = a.summary, a.holdings
    run = Run(spark, publish_root) if publish_root else None
    if run:
        holdings = run.write("Portfolios", in_order(holdings))
    if holdings_target:
        write_table(in_order(holdings), holdings_target)
        holdings = read_stocks(spark, holdings_target)
    detail = portfolio_detail(holdings, a.stock_history)
    if run:
        detail = run.write("PortfoliosDetail", detail)
        run.commit()
    if detail_target:
        write_table(detail, detail_target)
        detail = read_stocks(spark, detail_target)
    elif csv_path and snapshot_path:
        detail = materialize(detail, "detail")
    if csv_path:
        write_csv(detail, csv_path, single_file=csv_single_file)
    if snapshot_path:
        write_snapshot(detail, snapshot_path, run_date, fmt="csv")
    return PipelineOutputs(a, summary, holdings, detail)
