"""Data-quality rules, counted in aggregates and gated on the driver.

Every check is a DataFrame ``(table_name, rule, severity, violations)`` with one
row per rule. Only those rows reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import OUT_OF_RANGE
from ..schema import ID_LENGTH, MONEY, ORDER_STATUSES, STATUS_LENGTH

HARD, SOFT = "hard", "soft"
RANGE_RULES = ["price_range", "freight_value_range"]


class DataQualityError(ValueError):
    """A hard rule was violated."""

    def __init__(self, failed: list[Row]):
        self.failed = failed
        super().__init__(
            "; ".join(f"{r.table_name}.{r.rule}: {r.violations:,} violation(s)" for r in failed)
        )


def _unpivot(counted: DataFrame, table: str, severities: dict[str, str]) -> DataFrame:
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(rule).alias("rule"),
                        F.lit(severity).alias("severity"),
                        F.col(rule).alias("violations"),
                    )
                    for rule, severity in severities.items()
                ]
            )
        )
    )


def violation_counts(
    df: DataFrame, table: str, rules: dict[str, tuple[str, Column]]
) -> DataFrame:
    """Count the rows violating each rule in one pass; an unknown verdict passes."""
    counted = df.agg(*[F.count_if(bad).alias(rule) for rule, (_, bad) in rules.items()])
    return _unpivot(counted, table, {rule: severity for rule, (severity, _) in rules.items()})


def _duplicates(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows beyond the first of each key; missing keys are equal.

    Counts per key are combined before the shuffle, so a key that fills a third of
    the table costs one row per task.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("copies"))
    extra = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint")
    return per_key.agg(extra.alias(name))


def duplicate_order_ids(df: DataFrame) -> DataFrame:
    return _duplicates(df, "order_id", "duplicates")


def null_price_count(items: DataFrame) -> DataFrame:
    return items.agg(F.count_if(F.col("price").isNull()).alias("null_prices"))


def negative_price_count(items: DataFrame) -> DataFrame:
    return items.agg(F.count_if(F.col("price") < 0).alias("negative_prices"))


def presence_rules_orders() -> dict[str, tuple[str, Column]]:
    return {
        f"{name}_not_null": (HARD, F.col(name).isNull())
        for name in ["order_id", "customer_id", "order_status"]
    }


def domain_rules_orders() -> dict[str, tuple[str, Column]]:
    """Status within its domain; a missing status is the not-null rule's business."""
    return {"order_status_in_domain": (HARD, ~F.col("order_status").isin(ORDER_STATUSES))}


def price_rules_items() -> dict[str, tuple[str, Column]]:
    return {
        "price_not_null": (SOFT, F.col("price").isNull()),
        "price_not_negative": (HARD, F.col("price") < 0),
    }


def unique_order_id(orders: DataFrame) -> DataFrame:
    counted = _duplicates(orders, "order_id", "order_id_unique")
    return _unpivot(counted, "orders", {"order_id_unique": HARD})


def unique_item_id(items: DataFrame) -> DataFrame:
    """For items from elsewhere: ``surrogate_item_id`` makes unique ids by itself."""
    counted = _duplicates(items, "id", "id_unique")
    return _unpivot(counted, "order_items", {"id_unique": HARD})


def quality_orders(orders: DataFrame) -> DataFrame:
    """Key columns present, ``order_id`` unique.

    Two column-pruned scans instead of one: carrying the other counters through the
    per-key shuffle would cost more than reading one column again.
    """
    return violation_counts(orders, "orders", presence_rules_orders()).unionByName(
        unique_order_id(orders)
    )


def quality_items(items: DataFrame) -> DataFrame:
    return violation_counts(items, "order_items", price_rules_items())


def quality_status_domain(orders: DataFrame) -> DataFrame:
    return violation_counts(orders, "orders", domain_rules_orders())


def _too_long(name: str, limit: int) -> Column:
    return F.length(name) > limit


def _not_money(name: str, issue: str | None) -> Column:
    """An amount the curated column cannot hold, by its value or by the flag set in cleaning."""
    value = F.col(name)
    beyond = value.isNotNull() & value.try_cast(MONEY).isNull()
    if issue is None:
        return beyond
    return beyond | F.coalesce(F.col(issue) == OUT_OF_RANGE, F.lit(False))


def constraint_rules_orders() -> dict[str, tuple[str, Column]]:
    return {
        "order_purchase_timestamp_not_null": (HARD, F.col("order_purchase_timestamp").isNull()),
        "order_id_length": (HARD, _too_long("order_id", ID_LENGTH)),
        "customer_id_length": (HARD, _too_long("customer_id", ID_LENGTH)),
        "order_status_length": (HARD, _too_long("order_status", STATUS_LENGTH)),
    }


def constraint_rules_items(flagged: bool = False) -> dict[str, tuple[str, Column]]:
    """``flagged``: the items carry the issues that cleaning found."""
    price_beyond = _not_money("price", "price_issue" if flagged else None)
    freight_beyond = _not_money("freight_value", "freight_issue" if flagged else None)
    return {
        "order_id_not_null": (HARD, F.col("order_id").isNull()),
        "product_id_not_null": (HARD, F.col("product_id").isNull()),
        "price_missing": (HARD, F.col("price").isNull() & ~price_beyond),
        "price_negative": (HARD, F.col("price") < 0),
        "price_range": (HARD, price_beyond),
        # Cleaning keeps a row whose freight is bad, so a missing one only warns.
        "freight_value_missing": (SOFT, F.col("freight_value").isNull() & ~freight_beyond),
        "freight_value_negative": (HARD, F.col("freight_value") < 0),
        "freight_value_range": (HARD, freight_beyond),
        "order_id_length": (HARD, _too_long("order_id", ID_LENGTH)),
        "product_id_length": (HARD, _too_long("product_id", ID_LENGTH)),
    }


def quality_constraints(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The declared constraints of both tables, one scan of each."""
    rules = constraint_rules_items(flagged="price_issue" in items.columns)
    return violation_counts(orders, "orders", constraint_rules_orders()).unionByName(
        violation_counts(items, "order_items", rules)
    )


def load_checks_orders(orders: DataFrame) -> DataFrame:
    """Every rule on clean orders: one scan for the row rules, one for the key."""
    rules = presence_rules_orders() | domain_rules_orders() | constraint_rules_orders()
    return violation_counts(orders, "orders", rules).unionByName(unique_order_id(orders))


def load_checks_items(items: DataFrame) -> DataFrame:
    """Every rule on the items as they will be published, in one scan."""
    return violation_counts(items, "order_items", constraint_rules_items())


def range_checks(counts: dict[str, int]) -> list[Row]:
    """The range rules of a load, from counts taken while the items were written."""
    return [
        Row(table_name="order_items", rule=rule, severity=HARD, violations=counts[rule])
        for rule in RANGE_RULES
    ]


def quality_foreign_key(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items without an order, counted on one row per distinct key.

    Counting per key first keeps a hot order out of the join.
    """
    per_key = (
        items.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count("*").alias("item_count"))
    )
    orphans = per_key.join(orders.select("order_id"), "order_id", "left_anti")
    counted = orphans.agg(
        F.coalesce(F.sum("item_count"), F.lit(0)).cast("bigint").alias("order_id_known")
    )
    return _unpivot(counted, "order_items", {"order_id_known": HARD})


def enforce(checks: DataFrame | list[Row]) -> list[Row]:
    """Run the checks, raise on any hard violation, return the rows otherwise."""
    rows = checks if isinstance(checks, list) else checks.collect()  # one row per rule
    failed = [r for r in rows if r.severity == HARD and r.violations > 0]
    if failed:
        raise DataQualityError(failed)
    return rows
