"""From raw text columns to typed, narrowed tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    MONEY_ISSUES,
    OUT_OF_RANGE,
    missing_if_token,
    money_issue,
    narrow_money,
    parse_money,
    parse_timestamp,
    range_issue,
)
from ..schema import (
    ITEM_COLUMNS,
    MONEY,
    OPTIONAL_TIMESTAMPS,
    ORDER_COLUMNS,
    REQUIRED_TIMESTAMPS,
)


def normalize_null_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn missing-value tokens into NULL in the named or all string columns."""
    if columns is None:
        columns = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({name: missing_if_token(F.col(name)) for name in columns})


def parse_order_timestamps(orders: DataFrame, pattern: str | None = None) -> DataFrame:
    """Parse the timestamp columns; text of another form becomes NULL."""
    present = REQUIRED_TIMESTAMPS + [
        name for name in OPTIONAL_TIMESTAMPS if name in orders.columns
    ]
    return orders.withColumns(
        {name: parse_timestamp(F.col(name), pattern) for name in present}
    )


def fill_delivery_date(orders: DataFrame) -> DataFrame:
    """A missing delivery date takes the purchase timestamp."""
    return orders.withColumn(
        "order_delivered_customer_date",
        F.coalesce("order_delivered_customer_date", "order_purchase_timestamp"),
    )


def narrow_orders(orders: DataFrame) -> DataFrame:
    return orders.select(ORDER_COLUMNS)


def coerce_item_numbers(items: DataFrame) -> DataFrame:
    """Parse price and freight to wide amounts; bad text becomes NULL.

    Adds ``price_issue`` (unparseable and negative prices drop the row, one out of range is for
    the gate) and ``freight_issue`` (out of range or NULL). An amount that not even the wide
    type holds, an infinite one say, is NULL and has its issue.
    """
    # A generated column is computed once. As a plain one, the parsing would be copied to wherever
    # the optimizer moves a filter on it.
    names = items.columns
    texts = ["price", "freight_value"]
    parsed = items.select(
        "*", F.inline(F.array(F.struct(*(parse_money(F.col(n)).alias(f"_{n}") for n in texts))))
    )
    issues = F.struct(
        money_issue(F.col("price"), F.col("_price")).alias("price_issue"),
        range_issue(F.col("freight_value"), F.col("_freight_value")).alias("freight_issue"),
    )
    judged = parsed.select("*", F.inline(F.array(issues)))
    return judged.select(
        *(F.col(f"_{name}").alias(name) if name in texts else F.col(f"`{name}`") for name in names),
        "price_issue",
        "freight_issue",
    )


def _held(column: str = "price_issue") -> Column:
    """Whether an amount out of range is held for the gate."""
    return F.coalesce(F.col(column) == OUT_OF_RANGE, F.lit(False))


def drop_bad_prices(items: DataFrame) -> DataFrame:
    return items.filter(F.col("price").isNotNull() | _held())


def drop_negative_prices(items: DataFrame) -> DataFrame:
    return items.filter((F.col("price") >= 0) | _held())


def drop_unusable_items(coerced: DataFrame) -> DataFrame:
    """Both price filters at once, on the verdict reached from the text."""
    return coerced.filter(F.col("price_issue").isNull() | _held())


def dropped_item_counts(coerced: DataFrame) -> DataFrame:
    """Rows kept, dropped by reason and held for the gate, in one pass: (outcome, item_count)."""
    counts = {"kept": F.count_if(F.col("price_issue").isNull())}
    for issue in MONEY_ISSUES:
        counts[issue] = F.count_if(F.col("price_issue") == issue)
    counted = coerced.agg(*[c.alias(name) for name, c in counts.items()])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("outcome"), F.col(name).alias("item_count"))
                    for name in counts
                ]
            )
        )
    )


def narrow_items(items: DataFrame) -> DataFrame:
    """The curated columns and types; an amount out of range fails the job."""
    return items.select(
        "order_id",
        "product_id",
        narrow_money(F.col("price"), F.col("price_issue"), "price").alias("price"),
        narrow_money(F.col("freight_value"), F.col("freight_issue"), "freight_value").alias(
            "freight_value"
        ),
    )


def narrow_counted_items(items: DataFrame) -> DataFrame:
    """The same for a load that counts the amounts out of range and stops at the first."""
    return items.select(
        "order_id",
        "product_id",
        *(F.col(name).try_cast(MONEY).alias(name) for name in ["price", "freight_value"]),
    )


def default_freight(items: DataFrame) -> DataFrame:
    """The declared default, 0.00, for a missing freight value."""
    return items.withColumn(
        "freight_value", F.coalesce("freight_value", F.lit(0).cast(MONEY))
    )


def clean_orders(raw: DataFrame, pattern: str | None = None) -> DataFrame:
    """Raw text orders to the curated columns.

    Null tokens are replaced in the text columns only: none of them is a timestamp, so
    parsing makes them NULL by itself.
    """
    named = normalize_null_tokens(raw, ["order_id", "customer_id", "order_status"])
    return narrow_orders(fill_delivery_date(parse_order_timestamps(named, pattern)))


def coerce_items(raw: DataFrame) -> DataFrame:
    """Raw text items with numbers parsed and no row dropped. No null token is a number."""
    return coerce_item_numbers(normalize_null_tokens(raw, ["order_id", "product_id"]))


def clean_items(raw: DataFrame) -> DataFrame:
    """Raw text items without unusable prices: the curated columns, still wide, and the issues.

    What is out of range stays, flagged, for the gate; ``narrow_items`` comes after it.
    """
    kept = drop_unusable_items(coerce_items(raw))
    return kept.select(*ITEM_COLUMNS, "price_issue", "freight_issue")


def stamp_audit_columns(
    df: DataFrame, run_ts: datetime, columns: tuple[str, ...] = ("created_at", "updated_at")
) -> DataFrame:
    """Stamp the run's time, a parameter so that a re-run gives the same rows."""
    stamp = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumns({name: stamp for name in columns})


def surrogate_item_id(items: DataFrame) -> DataFrame:
    """Unique 64-bit ``id``, not dense: numbering rows densely needs a global sort."""
    return items.select(F.monotonically_increasing_id().alias("id"), "*")
