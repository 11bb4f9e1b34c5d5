"""Daily revenue over the curated tables: the report file, and the view by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import reports, snapshots
from ..sources import csv, runs
from . import etl

VIEW = "v_daily_revenue"


class ReportMismatch(ValueError):
    """The written report does not agree with its source."""


def write_daily_report(orders: DataFrame, items: DataFrame, path: str) -> int:
    """Write the report and return its number of days."""
    return csv.write_report(reports.daily_revenue_report(orders, items), path)


def write_checked_daily_report(orders: DataFrame, items: DataFrame, path: str) -> dict:
    """Write the report and return the digest of its rows, `digest_rows` of them."""
    return csv.write_checked_report(reports.daily_revenue_report(orders, items), path)


def verify_written_report(spark: SparkSession, path: str, written: dict) -> None:
    """Read the report back and compare it row for row with what was written, by digests.

    One scan of the file; neither the orders nor the items are read again. An empty report never
    matches.
    """
    found = snapshots.checksum(csv.read_report(spark, path))
    if found != written or not found["digest_rows"]:
        raise ReportMismatch(f"{path}: {found} read back, {written} written")


def verify_daily_report(
    spark: SparkSession, path: str, days: int, orders: DataFrame, items: DataFrame
) -> None:
    """Read the report back and compare it with the days written and with the source."""
    report = csv.read_report(spark, path)
    checks = reports.report_reconcile(report, days, orders, items).collect()
    failed = [row.asDict() for row in checks if not row.matches]
    if failed:
        raise ReportMismatch(f"{path}: {failed}")


def create_revenue_view(spark: SparkSession, root: str, name: str = VIEW) -> None:
    """The daily revenue view, by name, over the merged orders and items of the current run."""
    run = runs.current_run(spark, root)
    if run is None:
        raise ValueError(f"no load has finished under {root}")
    reports.daily_revenue_view(
        etl.read_current_orders(spark, run), etl.read_current_items(spark, run), unique=True
    ).createOrReplaceTempView(name)
