"""Reports against brute force, and against joining before summing."""

from collections import defaultdict
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderledger.functions import mean_money
from orderledger.operators import joins, reports
from orderledger.plans import daily_report
from orderledger.schema import CLEAN_ITEMS, CLEAN_ORDERS
from orderledger.sources import csv, runs

CENT = Decimal("0.01")


def orders(spark, rows):
    full = [
        (key, "c", status, day and datetime(2020, 1, day, 5), None) for key, status, day in rows
    ]
    return spark.createDataFrame(full, CLEAN_ORDERS)


def items(spark, rows):
    full = [(key, "p", price, None) for key, price in rows]
    return spark.createDataFrame(full, CLEAN_ITEMS)


def brute_force(order_rows, item_rows, active_only):
    days = defaultdict(list)
    for key, status, day in order_rows:
        if active_only and status in (None, "canceled", "unavailable"):
            continue
        for item_key, price in item_rows:
            if key is not None and key == item_key:
                days[day and date(2020, 1, day)].append((key, price))
    report = {}
    for day, sold in days.items():
        prices = [price for _, price in sold if price is not None]
        total = sum(prices) if prices else None
        mean = (total / len(prices)).quantize(CENT, ROUND_HALF_UP) if prices else None
        report[day] = (total, len({key for key, _ in sold}), mean)
    return report


def to_float(value):
    return None if value is None else float(value)


ORDER_ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.sampled_from(["created", "canceled", None]),
        st.sampled_from([1, 2, None]),
    ),
    max_size=6,
)
ITEM_ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "z", None]),
        st.one_of(st.none(), st.decimals("0", "99999999.99", places=2)),
    ),
    max_size=8,
)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(order_rows=ORDER_ROWS, item_rows=ITEM_ROWS)
def test_reports_equal_brute_force(spark, order_rows, item_rows):
    """Also with repeated order ids and missing keys, dates, prices and statuses."""
    o, i = orders(spark, order_rows), items(spark, item_rows)
    got = {
        r.report_date: (r.daily_revenue, r.order_count)
        for r in reports.daily_revenue_report(o, i).collect()
    }
    expected = brute_force(order_rows, item_rows, active_only=False)
    assert got == {d: (to_float(t), n) for d, (t, n, _) in expected.items()}
    got = {
        r.report_date: (r.daily_revenue, r.order_count, r.avg_order_value)
        for r in reports.daily_revenue_view(o, i).collect()
    }
    expected = brute_force(order_rows, item_rows, active_only=True)
    assert got == {d: (to_float(t), n, to_float(m)) for d, (t, n, m) in expected.items()}


def test_report_equals_the_plain_form(spark):
    from __spark_entry__ import items_of, orders_of

    o, i = orders_of(spark, "/root/testdata/sf0.001"), items_of(spark, "/root/testdata/sf0.001")
    plain = (
        joins.join_orders_items(o, i)
        .groupBy("report_date")
        .agg(
            F.sum("price").cast("double").alias("daily_revenue"),
            F.count_distinct("order_id").alias("order_count"),
        )
    )
    assert set(plain.collect()) == set(reports.daily_revenue_report(o, i).collect())


@pytest.mark.parametrize(
    "total, count, mean",
    [
        ("0.01", 2, 0.01),
        ("-0.01", 2, -0.01),
        ("0.03", 2, 0.02),
        ("1.00", 3, 0.33),
        ("0.00", 5, 0.0),
        # Just below half a cent: an intermediate rounding to 10 places gives 0.01.
        ("499999999.99", 100_000_000_000, 0.0),
        ("500000000.00", 100_000_000_000, 0.01),
        ("12345678901234567890.12", 1_000, 12345678901234567.89),
    ],
)
def test_mean_rounds_once(spark, total, count, mean):
    row = spark.range(1).select(
        mean_money(F.lit(total).cast("decimal(30,2)"), F.lit(count)).alias("m")
    )
    assert row.first().m == mean


def test_mean_of_nothing(spark):
    row = spark.range(1).select(
        mean_money(F.lit(None).cast("decimal(30,2)"), F.lit(0)).alias("m")
    )
    assert row.first().m is None


def test_order_of_days(spark):
    o = orders(spark, [("a", "created", 2), ("b", "created", 1), ("c", "created", None)])
    i = items(spark, [(k, Decimal("1.00")) for k in "abc"])
    days = [r.report_date for r in reports.daily_revenue_report(o, i).collect()]
    assert days == [None, date(2020, 1, 1), date(2020, 1, 2)]
    days = [r.report_date for r in reports.daily_revenue_view(o, i).collect()]
    assert days == [date(2020, 1, 1), date(2020, 1, 2), None]


def test_written_report_is_one_ordered_file(spark):
    o = orders(spark, [(str(n), "created", 1 + n % 28) for n in range(100)])
    i = items(spark, [(str(n), Decimal(n)) for n in range(100)])
    path = runs.new_path(spark, "report")
    assert daily_report.write_daily_report(o, i, path) == 28
    rows = csv.read_report(spark, path).collect()
    assert rows == reports.daily_revenue_report(o, i).collect()
    parts = spark.read.text(path).select(F.input_file_name()).distinct().count()
    assert parts == 1
    daily_report.verify_daily_report(spark, path, 28, o, i)


def test_verify_refuses_a_wrong_or_empty_report(spark):
    o = orders(spark, [("a", "created", 1)])
    i = items(spark, [("a", Decimal("1.00"))])
    path = runs.new_path(spark, "report")
    daily_report.write_daily_report(o, i, path)
    more = items(spark, [("a", Decimal("1.01"))])
    with pytest.raises(daily_report.ReportMismatch, match="total_revenue"):
        daily_report.verify_daily_report(spark, path, 1, o, more)
    empty = runs.new_path(spark, "report")
    assert daily_report.write_daily_report(o, i.limit(0), empty) == 0
    with pytest.raises(daily_report.ReportMismatch, match="report_days"):
        daily_report.verify_daily_report(spark, empty, 0, o, i.limit(0))


def test_the_file_is_compared_row_for_row_with_what_was_written(spark):
    days = [("a", "created", 1), ("b", "created", 2), ("c", "created", 2)]
    o = orders(spark, days)
    i = items(spark, [("a", Decimal("1.10")), ("b", Decimal("2.30")), ("c", Decimal("0.07"))])
    path = runs.new_path(spark, "report")
    written = daily_report.write_checked_daily_report(o, i, path)
    assert written["digest_rows"] == 2
    daily_report.verify_written_report(spark, path, written)
    report = csv.read_report(spark, path)
    # The totals of these files are right; a day's value, a date or a repeated day is not.
    swapped = report.withColumn(
        "daily_revenue", F.round(3.47 - F.col("daily_revenue"), 2)
    )
    moved = report.withColumn("report_date", F.date_add("report_date", 1))
    for wrong in (swapped, moved, report.unionAll(report), report.limit(1)):
        other = runs.new_path(spark, "report")
        csv.write_report(wrong, other)
        with pytest.raises(daily_report.ReportMismatch):
            daily_report.verify_written_report(spark, other, written)
    empty = runs.new_path(spark, "report")
    with pytest.raises(daily_report.ReportMismatch):
        nothing = daily_report.write_checked_daily_report(o, i.limit(0), empty)
        daily_report.verify_written_report(spark, empty, nothing)


def test_the_view_by_name_counts_unique_orders_plainly(spark):
    orders = spark.createDataFrame(
        [(k, "c", "created", datetime(2020, 1, 1), None) for k in "abc"], CLEAN_ORDERS
    )
    items = spark.createDataFrame(
        [(k, "p", Decimal("2.00"), None) for k in "aabx"], CLEAN_ITEMS
    )
    plain = reports.daily_revenue_view(orders, items, unique=True)
    assert plain.collect() == reports.daily_revenue_view(orders, items).collect()
    assert "distinct" not in plain._jdf.queryExecution().logical().toString()
