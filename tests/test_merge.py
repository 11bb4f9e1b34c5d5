"""The keyed merge: small cases and properties."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderledger.operators import cleaning, merge
from orderledger.schema import CLEAN_ORDERS, CURATED_ORDERS

FIRST, SECOND, THIRD = datetime(2024, 1, 1), datetime(2025, 1, 1), datetime(2026, 1, 1)


def order(key, status="created", day=1):
    return (key, "c", status, datetime(2020, 1, day), None)


def batch_of(spark, rows):
    return spark.createDataFrame(rows, CLEAN_ORDERS)


def target_of(spark, rows):
    return cleaning.stamp_audit_columns(batch_of(spark, rows), FIRST)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_update_keep(spark):
    target = target_of(spark, [order("kept"), order("hit")])
    batch = batch_of(spark, [order("hit", "delivered", 2), order("new")])
    merged = merge.upsert_orders(target, batch, SECOND)
    assert merged.schema.simpleString() == CURATED_ORDERS.simpleString()
    assert rows_of(merged) == [
        order("hit", "delivered", 2) + (FIRST, SECOND),
        order("kept") + (FIRST, FIRST),
        order("new") + (SECOND, SECOND),
    ]
    counts = merge.upsert_action_counts(target, batch)
    assert {tuple(r) for r in counts.collect()} == {("inserted", 1), ("updated", 1), ("kept", 1)}


def test_a_missing_value_in_the_batch_replaces_the_old_one(spark):
    target = target_of(spark, [order("a")[:4] + (FIRST,)])
    merged = merge.upsert_orders(target, batch_of(spark, [order("a")]), SECOND)
    assert merged.first().order_delivered_customer_date is None


def test_empty_batch_and_empty_target(spark):
    target = target_of(spark, [order("a")])
    assert rows_of(merge.upsert_orders(target, batch_of(spark, []), SECOND)) == rows_of(target)
    first = merge.upsert_orders(merge.empty_orders(spark), batch_of(spark, [order("a")]), FIRST)
    assert rows_of(first) == rows_of(target)


def test_a_checked_batch_is_merged_the_same_without_grouping(spark):
    target = target_of(spark, [order("kept"), order("hit")])
    batch = batch_of(spark, [order("hit", "delivered", 2), order("new")])
    merged = merge.upsert_orders(target, batch, SECOND, checked=True)
    assert rows_of(merged) == rows_of(merge.upsert_orders(target, batch, SECOND))
    assert "Aggregate" not in merged._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [[order("a"), order("a")], [order(None)]])
def test_unusable_keys_are_refused(spark, rows):
    batch = batch_of(spark, rows)
    target = target_of(spark, [order("b")])
    with pytest.raises(Exception, match="order_id"):
        merge.upsert_orders(target, batch, SECOND).collect()
    with pytest.raises(Exception, match="order_id"):
        merge.upsert_action_counts(target, batch).collect()


KEYS = st.dictionaries(
    st.text("abcdef", min_size=1, max_size=2), st.sampled_from(["created", "delivered"])
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(old=KEYS, new=KEYS)
def test_merge_equals_a_dictionary_update(spark, old, new):
    target = target_of(spark, [order(k, s) for k, s in old.items()])
    batch = batch_of(spark, [order(k, s) for k, s in new.items()])
    merged = merge.upsert_orders(target, batch, SECOND)
    expected = {k: (s, FIRST, FIRST) for k, s in old.items()}
    expected |= {k: (s, FIRST if k in old else SECOND, SECOND) for k, s in new.items()}
    got = {r.order_id: (r.order_status, r.created_at, r.updated_at) for r in merged.collect()}
    assert got == expected
    again = merge.upsert_orders(merged, batch, SECOND)
    assert rows_of(again) == rows_of(merged)
