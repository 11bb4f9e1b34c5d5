"""Daily revenue.

Items are summed per order before the join. That combines rows ahead of the shuffle,
so an order that holds a third of all items reaches the join as a single row, and it
leaves the join output partitioned by ``order_id``, which the distinct count of
orders needs anyway. The result equals that of joining first, whether or not
``order_id`` is unique in the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import mean_money
from .joins import active_orders, order_report_date


def _items_per_order(items: DataFrame) -> DataFrame:
    return (
        items.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.sum("price").alias("amount"), F.count("price").alias("priced"))
    )


def _per_day(orders: DataFrame, items: DataFrame, unique: bool = False) -> DataFrame:
    joined = order_report_date(orders).join(_items_per_order(items), "order_id")
    return joined.groupBy("report_date").agg(
        F.sum("amount").alias("amount"),
        F.sum("priced").alias("priced"),
        # Of unique orders each is one joined row.
        (F.count("order_id") if unique else F.count_distinct("order_id")).alias("order_count"),
    )


def daily_sums(orders: DataFrame, items: DataFrame, unique: bool = False) -> DataFrame:
    """(report_date, amount, priced, order_count) over the orders given: sums that add up.

    ``unique``: no order_id is there twice, as in the tables of a load.
    """
    return _per_day(orders, items, unique)


def daily_revenue_report(orders: DataFrame, items: DataFrame) -> DataFrame:
    """``(report_date, daily_revenue, order_count)`` over orders of every status."""
    return (
        _per_day(orders, items)
        .select(
            "report_date",
            F.round("amount", 2).cast("double").alias("daily_revenue"),
            "order_count",
        )
        .orderBy("report_date")
    )


def daily_revenue_view(orders: DataFrame, items: DataFrame, unique: bool = False) -> DataFrame:
    """Revenue of active orders, with ``avg_order_value``, the mean *item price*.

    ``unique``: see `daily_sums`.
    """
    return (
        _per_day(active_orders(orders), items, unique)
        .select(
            "report_date",
            "order_count",
            F.round("amount", 2).cast("double").alias("daily_revenue"),
            mean_money(F.col("amount"), F.col("priced")).alias("avg_order_value"),
        )
        .orderBy(F.asc_nulls_last("report_date"))
    )


def _source_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue and orders of the whole report by another way than day by day.

    Items are summed per order, kept where the order is known, and summed up: no join brings
    dates and prices together. Order ids are unique, which the load's gate has checked.
    """
    known = _items_per_order(items).join(orders.select("order_id"), "order_id", "left_semi")
    return known.agg(
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total_revenue"),
        F.count("*").alias("total_orders"),
    )


def report_reconcile(
    report: DataFrame, days: int, orders: DataFrame, items: DataFrame
) -> DataFrame:
    """A written report against its source: ``(check_name, reported, expected, matches)``.

    ``days`` is what the writing stage has counted. An empty report never matches. The report
    holds doubles, so revenue matches to half a cent or to a double's precision.
    """
    reported = report.agg(
        F.count("*").alias("report_days"),
        F.coalesce(F.sum(F.col("daily_revenue").cast("decimal(20,2)")), F.lit(0)).alias(
            "total_revenue"
        ),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("total_orders"),
    )
    expected = _source_totals(orders, items).withColumn("report_days", F.lit(days))

    def as_checks(totals: DataFrame, value: str) -> DataFrame:
        names = ["report_days", "total_revenue", "total_orders"]
        rows = [
            F.struct(F.lit(n).alias("check_name"), F.col(n).cast("decimal(38,2)").alias(value))
            for n in names
        ]
        return totals.select(F.inline(F.array(*rows)))

    both = as_checks(reported, "reported").join(as_checks(expected, "expected"), "check_name")
    near = F.greatest(F.lit(0.005), F.abs(F.col("expected")).cast("double") * 2.0**-52)
    off = F.abs(F.col("reported") - F.col("expected")).cast("double")
    exact = F.col("reported") == F.col("expected")
    revenue = F.col("check_name") == "total_revenue"
    nonempty = (F.col("check_name") != "report_days") | (F.col("reported") > 0)
    return both.withColumn("matches", F.when(revenue, off <= near).otherwise(exact) & nonempty)
