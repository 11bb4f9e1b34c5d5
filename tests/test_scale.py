"""Plans and skew: what must hold so that the work spreads over a cluster."""

import contextlib
import re
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderledger.operators import cleaning, joins, merge, quality, reports
from orderledger.schema import MONEY
from orderledger.sources import parquet, runs

DAY = datetime(2024, 1, 1)


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


@pytest.fixture
def no_broadcast(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        yield


@pytest.fixture(scope="module")
def tables(spark):
    """5,000 orders, 60,000 items; a third of the items belong to order '0'."""
    orders = spark.range(5000).select(
        F.col("id").cast("string").alias("order_id"),
        F.lit("c").alias("customer_id"),
        F.when(F.col("id") % 10 == 9, "canceled").otherwise("created").alias("order_status"),
        F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(cast(id % 300 as int))").alias(
            "order_purchase_timestamp"
        ),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
    )
    items = spark.range(60000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "0").otherwise((F.col("id") % 5500).cast("string")).alias(
            "order_id"
        ),
        F.sha2(F.col("id").cast("string"), 256).alias("product_id"),
        (F.col("id") % 1000 / 100).cast(MONEY).alias("price"),
        F.lit(Decimal("0.10")).cast(MONEY).alias("freight_value"),
    )
    paths = []
    for name, df in [("orders", orders), ("items", items)]:
        paths.append(runs.new_path(spark, name))
        df.write.parquet(paths[-1])
    return tuple(spark.read.parquet(path) for path in paths)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan):
    return re.findall(r"Exchange (\w+)\(?([\w#]*)", plan)


def test_report_shuffles_partial_sums_only(spark, tables, no_broadcast):
    plan = planned(reports.daily_revenue_report(*tables))
    kinds = [(kind, column.split("#")[0]) for kind, column in shuffles(plan)]
    assert kinds == [
        ("rangepartitioning", "report_date"),
        ("hashpartitioning", "report_date"),
        ("hashpartitioning", "order_id"),
        ("hashpartitioning", "order_id"),
    ]
    items_side = plan[plan.rindex("Exchange hashpartitioning(order_id") :]
    assert "functions=[partial_sum(price" in items_side
    assert "ReadSchema: struct<order_id:string,price:decimal(10,2)>" in items_side
    assert "PushedFilters: [IsNotNull(order_id)]" in items_side
    assert "order_purchase_timestamp:timestamp_ntz>" in plan and "customer_id" not in plan


def test_view_pushes_its_filter_down(spark, tables, no_broadcast):
    plan = planned(reports.daily_revenue_view(*tables))
    assert "Not(In(order_status, [canceled,unavailable]))" in plan
    assert len(shuffles(plan)) == 4


def test_cleaning_does_not_shuffle(spark):
    raw = spark.createDataFrame(
        [("a", "p", "1", "1")],
        "order_id string, product_id string, price string, freight_value string",
    )
    narrow = cleaning.narrow_items(cleaning.clean_items(raw))
    plan = planned(cleaning.surrogate_item_id(narrow))
    assert "Exchange" not in plan and "Python" not in plan


def test_merge_shuffles_each_side_once(spark, tables, no_broadcast):
    orders, _ = tables
    target = cleaning.stamp_audit_columns(orders, DAY)
    plan = planned(merge.upsert_orders(target, orders, DAY))
    assert len(shuffles(plan)) == 2
    counts = planned(merge.upsert_action_counts(target, orders))
    assert counts.count("ReadSchema: struct<order_id:string>") == 2


def test_duplicates_are_combined_before_the_shuffle(spark, tables):
    plan = planned(quality.duplicate_order_ids(tables[1]))
    below = plan[plan.index("Exchange hashpartitioning(order_id") :]
    assert "partial_count" in below and "ReadSchema: struct<order_id:string>" in below


@pytest.mark.parametrize(
    "build, plain",
    [
        (
            joins.join_orders_items,
            lambda o, i: joins.order_report_date(o).join(i.select("order_id", "price"), "order_id"),
        ),
        (joins.join_using, lambda o, i: o.join(i, "order_id")),
        (
            lambda o, i: joins.orphan_items(i, o.filter("order_id <> '0'")),
            lambda o, i: i.join(o.filter("order_id <> '0'"), "order_id", "left_anti"),
        ),
        (
            lambda o, i: joins.cascade_delete_items(i, o.filter("order_id <> '0'")),
            lambda o, i: i.join(o.filter("order_id <> '0'"), "order_id", "left_anti"),
        ),
    ],
    ids=["join_orders_items", "join_using", "orphan_items", "cascade_delete_items"],
)
def test_hot_order_is_split_over_tasks(spark, tables, no_broadcast, build, plain):
    """With the settings as they are: no threshold has to be met."""
    never = {"spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
    never |= {"spark__sql__adaptive__coalescePartitions__enabled": "false"}
    with settings(spark, spark__sql__shuffle__partitions="64", **never):
        df = build(*tables)
        hot = df.filter("order_id = '0'").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) > 4 and sum(r["count"] for r in hot) > 20000
        assert max(r["count"] for r in hot) < 10000
        names = sorted(df.columns)
        got = sorted(map(tuple, df.select(names).collect()), key=str)
        assert got == sorted(map(tuple, plain(*tables).select(names).collect()), key=str)


def test_items_without_a_key_stay_and_join_nothing(spark, tables):
    orders, items = tables
    none = items.limit(50).withColumn("order_id", F.lit(None).cast("string"))
    left = joins.cascade_delete_items(items.unionByName(none), orders)
    assert left.filter("order_id IS NULL").count() == 50
    assert joins.orphan_items(none, orders).count() == 0


def test_report_with_a_hot_order_equals_joining_first(spark, tables):
    plain = (
        joins.join_orders_items(*tables)
        .groupBy("report_date")
        .agg(
            F.sum("price").cast("double").alias("daily_revenue"),
            F.count_distinct("order_id").alias("order_count"),
        )
    )
    got = reports.daily_revenue_report(*tables).collect()
    assert len(got) == 300 and set(got) == set(plain.collect())


def test_hot_month_is_split_over_files(spark, tables):
    stamped = cleaning.stamp_audit_columns(
        tables[0].withColumn(
            "order_purchase_timestamp", F.lit("2020-01-15").cast("timestamp_ntz")
        ),
        DAY,
    ).repartition(16)
    path = runs.new_path(spark, "orders")
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB"):
        parquet.write_orders_by_month(stamped, path)
    files = parquet.read_orders_by_month(spark, path).select(F.input_file_name()).distinct()
    assert files.count() > 1
    assert parquet.read_orders_by_month(spark, path).count() == 5000
