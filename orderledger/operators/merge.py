"""Keyed merge of a batch of clean orders into the curated orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CURATED_ORDERS, ORDER_COLUMNS

KEY = "order_id"
UPDATED_COLUMNS = [name for name in ORDER_COLUMNS if name != KEY]
OLD = UPDATED_COLUMNS + ["created_at", "updated_at"]


def _one_row_per_key(batch: DataFrame, value: Column) -> DataFrame:
    """The batch as ``(order_id, new)``; a duplicate or missing key fails the job.

    Grouping costs no shuffle of its own: the join needs the same partitioning. Rows
    combine before the shuffle, so a hot key does not pile up in one task either.
    """
    grouped = batch.groupBy(KEY).agg(
        F.first(value).alias("new"), F.count("*").alias("copies")
    )
    return grouped.select(
        KEY,
        F.when(F.col(KEY).isNull(), F.raise_error(F.lit("batch has a missing order_id")))
        .when(
            F.col("copies") > 1,
            F.raise_error(F.concat(F.lit("batch has duplicate order_id "), F.col(KEY))),
        )
        .otherwise(F.col("new"))
        .alias("new"),
    )


def _matched(target: DataFrame, old: Column, batch: DataFrame) -> DataFrame:
    """``(order_id, old, new)``: NULL on the side that lacks the order."""
    return target.select(KEY, old.alias("old")).join(batch, KEY, "full_outer")


def _merged(matched: DataFrame, run_ts: datetime) -> DataFrame:
    now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    in_batch = F.col("new").isNotNull()

    def pick(name: str) -> Column:
        return F.when(in_batch, F.col("new")[name]).otherwise(F.col("old")[name])

    return matched.select(
        KEY,
        *[pick(name).alias(name) for name in UPDATED_COLUMNS],
        F.when(F.col("old").isNull(), now).otherwise(F.col("old.created_at")).alias("created_at"),
        F.when(in_batch, now).otherwise(F.col("old.updated_at")).alias("updated_at"),
    )


def upsert_orders(
    target: DataFrame, batch: DataFrame, run_ts: datetime, checked: bool = False
) -> DataFrame:
    """The curated orders after the batch.

    A known order takes the batch's values and the run's ``updated_at`` and keeps its
    ``created_at``; a new one gets both stamps; the others stay as they are. Writing
    the result over the target is refused by Spark, so write it to a new path. ``checked``: the
    caller has found no key of the batch repeated or missing, so they are not sorted to find any.
    """
    values = F.struct(UPDATED_COLUMNS)
    guarded = batch.select(KEY, values.alias("new")) if checked else _one_row_per_key(batch, values)
    return _merged(_matched(target, F.struct(OLD), guarded), run_ts)


def upsert_action_counts(target: DataFrame, batch: DataFrame) -> DataFrame:
    """How many orders the merge inserts, updates and keeps: ``(action, order_count)``."""
    action = (
        F.when(F.col("old").isNull(), "inserted")
        .when(F.col("new").isNotNull(), "updated")
        .otherwise("kept")
    )
    matched = _matched(target, F.lit(True), _one_row_per_key(batch, F.lit(True)))
    return matched.groupBy(action.alias("action")).agg(F.count("*").alias("order_count"))


def empty_orders(spark) -> DataFrame:
    """The curated orders before the first batch."""
    return spark.createDataFrame([], CURATED_ORDERS)
