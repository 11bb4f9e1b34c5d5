"""The daily revenue view kept up by differences.

The state is a row per day with what the view is made of: the amount, the priced items and the number
of orders. An order belongs to one day, so the number of orders adds up over orders and a load changes
the state by signed contributions: those of the orders it touched as they are now, less those of the
same orders as they were. A day without orders is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import mean_money
from ..operators import joins, reports, snapshots
from ..sources import parquet
from . import etl

ITEM_COLUMNS = ["order_id", "product_id", "price", "freight_value"]


def daily_state(orders: DataFrame, items: DataFrame) -> DataFrame:
    """(report_date, amount, priced, order_count) of the active orders, which are those of a load."""
    return reports.daily_sums(joins.active_orders(orders), items, unique=True)


def _added_up(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("report_date").agg(
        F.sum("amount").cast("decimal(28,2)").alias("amount"),
        F.sum("priced").alias("priced"),
        F.sum("order_count").alias("order_count"),
    )


def _negative(state: DataFrame) -> DataFrame:
    return state.select(
        "report_date", *((-F.col(name)).alias(name) for name in ["amount", "priced", "order_count"])
    )


def changed_days(
    old_orders: DataFrame, old_items: DataFrame, new_orders: DataFrame, new_items: DataFrame
) -> DataFrame:
    """The signed change of the state from these orders, which are the same ones before and after."""
    return _added_up([daily_state(new_orders, new_items), _negative(daily_state(old_orders, old_items))])


def touched_months(before: Row | None, after: Row) -> tuple[list[str], list[str]]:
    """Folders of the months that a run has rewritten, of the run before and of the run itself."""
    old = {} if before is None else before.order_months
    new = after.order_months
    touched = sorted(month for month in {*old, *new} if old.get(month) != new.get(month))
    return [old[m] for m in touched if m in old], [new[m] for m in touched if m in new]


def refreshed_state(spark: SparkSession, state: DataFrame, before: Row, after: Row) -> DataFrame:
    """The state after a run, from that after the run before.

    Of the orders only the months that the run rewrote are read. Where items have changed, which the
    tables' digests tell, so are the orders of these items in other months.
    """
    old_items = etl.read_current_items(spark, before).select(ITEM_COLUMNS)
    new_items = etl.read_current_items(spark, after).select(ITEM_COLUMNS)
    old_folders, new_folders = touched_months(before, after)
    old_orders = parquet.read_month_folders(spark, old_folders)
    new_orders = parquet.read_month_folders(spark, new_folders)
    kept = sorted(set(before.order_months.values()) & set(after.order_months.values()))
    # Without a month that stayed there is no order elsewhere.
    if kept and snapshots.checksum(old_items) != snapshots.checksum(new_items):
        changed = snapshots.changed_rows(old_items, new_items).select("order_id").distinct()
        others = parquet.read_month_folders(spark, kept).join(changed, "order_id", "left_semi")
        old_orders, new_orders = old_orders.unionByName(others), new_orders.unionByName(others)
    change = changed_days(old_orders, old_items, new_orders, new_items)
    return _added_up([state, change]).filter("order_count > 0")


def view_of(state: DataFrame) -> DataFrame:
    """The columns of the daily revenue view."""
    return state.select(
        "report_date",
        "order_count",
        F.round("amount", 2).cast("double").alias("daily_revenue"),
        mean_money(F.col("amount"), F.col("priced")).alias("avg_order_value"),
    )
