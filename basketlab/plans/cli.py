"""spark-submit entry point for the daily batch.

    spark-submit -m basketlab.plans.cli upload  --docs <folder> --stocks <table or path>
    spark-submit -m basketlab.plans.cli analyze --stocks <table or path> --index <csv> \
        --companies <csv> --holdings <target> --detail <target> [--csv <folder>] [--archive <folder>]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from basketlab.config import DEFAULT_UNIVERSE, PipelineConfig
from basketlab.plans.pipeline import run_pipeline, upload_prices


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="basketlab")
    sub = p.add_subparsers(dest="cmd", required=True)
    up = sub.add_parser("upload", help="JSON price documents -> stocks table")
    up.add_argument("--docs", required=True)
    up.add_argument("--stocks", required=True)
    up.add_argument("--buckets", type=int, help="store a catalog table bucketed by symbol")
    an = sub.add_parser("analyze", help="stocks + index + companies -> basket report")
    an.add_argument("--stocks", required=True)
    an.add_argument("--index", required=True)
    an.add_argument("--companies", required=True)
    an.add_argument("--holdings", default="Portfolios")
    an.add_argument("--detail", default="PortfoliosDetail")
    an.add_argument("--csv")
    an.add_argument("--archive", help="dated archive of the report (one partition per run date)")
    an.add_argument("--archive-inputs", help="dated archive of the input stocks table")
    an.add_argument("--run-date", default=dt.date.today().isoformat())
    an.add_argument("--universe", default=",".join(DEFAULT_UNIVERSE), help="comma-separated tickers (default: the original list), or 'all' for every ticker in the data")
    an.add_argument("--corr-lo", type=float, default=0.5)
    an.add_argument("--corr-hi", type=float, default=0.99)
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"basketlab-{args.cmd}").enableHiveSupport().getOrCreate()
    # upload and analysis are separate applications that meet in a catalog table
    if args.cmd == "upload":
        upload_prices(spark, args.docs, args.stocks, buckets=args.buckets)
        return
    cfg = PipelineConfig(
        universe=None if args.universe == "all" else tuple(args.universe.split(",")),
        corr_lo=args.corr_lo,
        corr_hi=args.corr_hi,
    )
    run_pipeline(
        spark,
        args.stocks,
        args.index,
        args.companies,
        cfg,
        holdings_target=args.holdings,
        detail_target=args.detail,
        csv_path=args.csv,
        snapshot_path=args.archive,
        run_date=args.run_date,
        inputs_archive_path=args.archive_inputs,
    )


if __name__ == "__main__":
    main()
