"""The gate raises for each hard rule, not for the soft ones."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderledger.operators import quality
from orderledger.schema import CLEAN_ITEMS, CLEAN_ORDERS

NOON = datetime(2024, 1, 1, 12)
GOOD_ORDER = ("a", "c", "created", NOON, NOON)
OTHER_ORDER = ("b", "c", "created", NOON, NOON)
GOOD_ITEM = ("a", "p", Decimal("1.00"), Decimal("0.50"))


def changed(row, position, value):
    return row[:position] + (value,) + row[position + 1 :]


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), CLEAN_ORDERS)


def items(spark, *rows):
    return spark.createDataFrame(list(rows), CLEAN_ITEMS)


def all_checks(orders, items):
    return (
        quality.quality_orders(orders)
        .unionByName(quality.quality_status_domain(orders))
        .unionByName(quality.quality_items(items))
        .unionByName(quality.quality_constraints(orders, items))
        .unionByName(quality.quality_foreign_key(items, orders))
    )


def fired(checks):
    return {r.rule for r in checks.collect() if r.violations}


def test_good_rows_pass(spark):
    checks = all_checks(orders(spark, GOOD_ORDER), items(spark, GOOD_ITEM))
    rows = quality.enforce(checks)
    assert not any(r.violations for r in rows)


@pytest.mark.parametrize(
    "row, rule",
    [
        (changed(GOOD_ORDER, 0, None), "order_id_not_null"),
        (changed(OTHER_ORDER, 1, None), "customer_id_not_null"),
        (changed(OTHER_ORDER, 2, None), "order_status_not_null"),
        (changed(OTHER_ORDER, 2, "lost"), "order_status_in_domain"),
        (changed(OTHER_ORDER, 3, None), "order_purchase_timestamp_not_null"),
        (changed(GOOD_ORDER, 0, "x" * 51), "order_id_length"),
        (changed(OTHER_ORDER, 1, "x" * 51), "customer_id_length"),
        (GOOD_ORDER, "order_id_unique"),
    ],
)
def test_bad_order_raises(spark, row, rule):
    frame = orders(spark, GOOD_ORDER, row)
    checks = all_checks(frame, items(spark, GOOD_ITEM))
    assert fired(checks) == {rule}
    with pytest.raises(quality.DataQualityError, match=rule):
        quality.enforce(checks)


def test_long_status_is_outside_the_domain_too(spark):
    frame = orders(spark, changed(GOOD_ORDER, 2, "x" * 21))
    assert fired(quality.quality_constraints(frame, items(spark, GOOD_ITEM))) == {
        "order_status_length"
    }


@pytest.mark.parametrize(
    "row, rules",
    [
        (changed(GOOD_ITEM, 0, None), {"order_id_not_null"}),
        (changed(GOOD_ITEM, 0, "b"), {"order_id_known"}),
        (changed(GOOD_ITEM, 1, None), {"product_id_not_null"}),
        (changed(GOOD_ITEM, 1, "x" * 51), {"product_id_length"}),
        (changed(GOOD_ITEM, 2, None), {"price_not_null", "price_missing"}),
        (changed(GOOD_ITEM, 2, Decimal("-0.01")), {"price_not_negative", "price_negative"}),
        (changed(GOOD_ITEM, 3, Decimal("-0.01")), {"freight_value_negative"}),
    ],
)
def test_bad_item_raises(spark, row, rules):
    checks = all_checks(orders(spark, GOOD_ORDER), items(spark, GOOD_ITEM, row))
    assert fired(checks) == rules
    with pytest.raises(quality.DataQualityError):
        quality.enforce(checks)


def test_missing_freight_only_warns(spark):
    checks = all_checks(
        orders(spark, GOOD_ORDER), items(spark, changed(GOOD_ITEM, 3, None))
    )
    assert fired(checks) == {"freight_value_missing"}
    quality.enforce(checks)


def test_unparseable_price_only_warns_in_the_cleaning_gate(spark):
    checks = quality.quality_items(items(spark, changed(GOOD_ITEM, 2, None)))
    assert fired(checks) == {"price_not_null"}
    quality.enforce(checks)


def test_range_rule_on_wider_columns(spark):
    wide = items(spark, GOOD_ITEM).withColumn("price", F.lit("123456789012").cast("decimal(20,2)"))
    checks = quality.violation_counts(wide, "order_items", quality.constraint_rules_items())
    assert fired(checks) == {"price_range"}


def test_missing_keys_count_as_equal(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("a",), (None,), (None,)], "order_id string")
    assert quality.duplicate_order_ids(keys).first().duplicates == 3
    assert quality.duplicate_order_ids(keys.limit(0)).first().duplicates == 0


def test_checks_on_empty_tables(spark):
    quality.enforce(all_checks(orders(spark), items(spark)))


def test_repeated_item_ids(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    assert fired(quality.unique_item_id(ids)) == {"id_unique"}
    assert not fired(quality.unique_item_id(ids.distinct()))
