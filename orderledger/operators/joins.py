"""Joins between orders and items.

No join carries a broadcast hint on one of the tables: nothing bounds their size, so the choice is
left to the size checks of the optimizer and of adaptive execution.

The joins that return items deal out the heavy orders, those with more than a thousandth of the
items, and only these: the items of a heavy order go in turn to as many parts as it has thousandths,
also where they are equal, and the order is there once for each part. So no part holds much more
than a thousandth of the items, whatever one order has. Finding the heavy orders takes a pass over
the items' keys (`frequent`). The turn is an item's place in its map task, which a retried task
gives again as long as its input comes in the same order, as files do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import INACTIVE_STATUSES
from .frequent import copies_of_heavy_keys

PART = "_part"


def active_orders(orders: DataFrame) -> DataFrame:
    """Orders that earn revenue. A NULL status is not active."""
    return orders.filter(~F.col("order_status").isin(INACTIVE_STATUSES))


def order_report_date(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", F.to_date("order_purchase_timestamp").alias("report_date")
    )


def _dealt(items: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the columns to join on: the key alone where no order is heavy."""
    copies = copies_of_heavy_keys(items, "order_id")
    if not copies:
        return items, orders, ["order_id"]
    # Fewer than a thousand rows, see `frequent`.
    heavy = F.broadcast(
        items.sparkSession.createDataFrame(sorted(copies.items()), "order_id string, _copies int")
    )
    turn = F.pmod(F.monotonically_increasing_id(), F.coalesce("_copies", F.lit(1))).cast("int")
    parts = F.explode(F.expr("sequence(0, coalesce(_copies, 1) - 1)"))
    return (
        items.join(heavy, "order_id", "left").withColumn(PART, turn).drop("_copies"),
        orders.join(heavy, "order_id", "left").withColumn(PART, parts).drop("_copies"),
        ["order_id", PART],
    )


def _without_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    keys = orders.select("order_id").filter("order_id IS NOT NULL")
    items, keys, on = _dealt(items, keys)
    return items.join(keys, on, "left_anti").drop(PART)


def join_orders_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per item of a known order: ``(order_id, report_date, price)``."""
    priced, dated, on = _dealt(items.select("order_id", "price"), order_report_date(orders))
    return dated.join(priced, on).select("order_id", "report_date", "price")


def join_using(orders: DataFrame, items: DataFrame) -> DataFrame:
    """All columns of both tables, one key column."""
    items, orders, on = _dealt(items, orders)
    return orders.join(items, on).drop(PART)


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items that point at no order. A missing key points nowhere and is no orphan."""
    return _without_orders(items.filter(F.col("order_id").isNotNull()), orders)


def cascade_delete_items(items: DataFrame, deleted_orders: DataFrame) -> DataFrame:
    """Items left after their orders were deleted. Those without a key stay, and go to no join."""
    keyed = _without_orders(items.filter(F.col("order_id").isNotNull()), deleted_orders)
    return keyed.unionByName(items.filter(F.col("order_id").isNull()))
