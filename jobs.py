"""The two daily jobs, for spark-submit.

    spark-submit jobs.py load --orders RAW --items RAW --root CURATED
    spark-submit jobs.py report --root CURATED --out REPORT

``report`` writes the CSV and then compares the file with what was written, and with another
computation from its source if ``--against-source`` is given. Either job exits
with an error, and leaves the current tables as they are, when a check fails.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from orderledger.plans import daily_report, etl
from orderledger.sources import parquet, runs


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    result = etl.run_etl(
        spark,
        args.orders,
        args.items,
        args.root,
        args.run_ts,
        multi_line=args.multi_line,
        pattern=args.timestamps,
    )
    print(f"run {result.run.run_number}: merged {result.order_rows} orders")
    print(f"loaded {result.item_rows} items, dropped {result.dropped_items}")
    for row in result.checks:
        if row.violations:
            print(f"warning: {row.violations} rows of {row.table_name} fail {row.rule}")


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    run = runs.current_run(spark, args.root)
    if run is None:
        raise SystemExit(f"no load has finished under {args.root}")
    orders = parquet.read_parquet(spark, run.orders_clean_path)
    items = parquet.read_parquet(spark, run.items_path)
    written = daily_report.write_checked_daily_report(orders, items, args.out)
    daily_report.verify_written_report(spark, args.out, written)
    days = written["digest_rows"]
    if args.against_source:
        daily_report.verify_daily_report(spark, args.out, days, orders, items)
    print(f"wrote and verified {days} days")


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser()
    jobs = parser.add_subparsers(required=True)

    job = jobs.add_parser("load")
    job.add_argument("--orders", required=True, help="raw orders, CSV file or folder")
    job.add_argument("--items", required=True, help="raw order items, CSV file or folder")
    job.add_argument("--root", required=True, help="folder of the curated tables")
    job.add_argument(
        "--run-ts",
        type=datetime.fromisoformat,
        default=datetime.now(timezone.utc).replace(tzinfo=None),
        help="audit time, UTC now by default",
    )
    job.add_argument(
        "--multi-line",
        action="store_true",
        help="cells may hold line breaks; each file is then read by one task",
    )
    job.add_argument(
        "--timestamps",
        help="datetime pattern of the timestamps, MM/dd/yyyy H:m:s say; ISO without it",
    )
    job.set_defaults(run=load)

    job = jobs.add_parser("report")
    job.add_argument("--root", required=True, help="folder of the curated tables")
    job.add_argument("--out", required=True, help="folder of the CSV report")
    job.add_argument(
        "--against-source",
        action="store_true",
        help="compare the totals with another computation from the source, too",
    )
    job.set_defaults(run=report)
    return parser.parse_args(arguments)


def main() -> None:
    args = parse()
    spark = SparkSession.builder.appName("orderledger").getOrCreate()
    try:
        args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
