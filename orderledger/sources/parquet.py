"""Parquet tables: clean orders, and the curated orders laid out by month."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CURATED_ORDERS

MONTH = "purchase_month"


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def month_of_purchase() -> Column:
    """The month as a number, 202405 for May 2024."""
    purchased = F.col("order_purchase_timestamp")
    return (F.year(purchased) * 100 + F.month(purchased)).alias(MONTH)


def write_orders_by_month(orders: DataFrame, path: str) -> None:
    """Orders partitioned by purchase month, for access by date and for merging by month.

    It costs one more shuffle of what is written. The rebalance hint lets adaptive execution
    gather a month into files of the advisory size and split a large month over several tasks.
    """
    (
        orders.withColumn(MONTH, month_of_purchase())
        .hint("rebalance", MONTH)
        .write.mode("overwrite")
        .partitionBy(MONTH)
        .parquet(path)
    )


def month_folder(path: str, month: int) -> str:
    """Where ``write_orders_by_month`` has put a month."""
    return f"{path}/{MONTH}={month}"


def read_month_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Curated orders of some month folders, of whichever runs; none of them gives no rows."""
    if not folders:
        return spark.createDataFrame([], CURATED_ORDERS)
    return spark.read.schema(CURATED_ORDERS).parquet(*folders)


def read_orders_by_month(
    spark: SparkSession, path: str, first_day: date | None = None, last_day: date | None = None
) -> DataFrame:
    """Curated orders, only the months between the two days when they are given."""
    schema = CURATED_ORDERS.simpleString()[len("struct<") : -1].replace(":", " ")
    orders = spark.read.schema(f"{schema}, {MONTH} INT").parquet(path)
    purchased = F.col("order_purchase_timestamp")
    if first_day is not None:
        start = F.lit(first_day.isoformat()).cast("timestamp_ntz")
        orders = orders.filter(
            (F.col(MONTH) >= first_day.year * 100 + first_day.month) & (purchased >= start)
        )
    if last_day is not None:
        end = F.lit((last_day + timedelta(days=1)).isoformat()).cast("timestamp_ntz")
        orders = orders.filter(
            (F.col(MONTH) <= last_day.year * 100 + last_day.month) & (purchased < end)
        )
    return orders.drop(MONTH)
