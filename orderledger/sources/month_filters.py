"""Bloom filters of the order ids of each month folder, kept beside the folders of their run.

A batch's orders may lie in any month. Instead of reading the ids of all months, a load asks their
filters, some 24 bits an order, and reads only the months whose filter has one of the batch's ids.
A filter never denies an id that is there; one in several thousand that is not it takes for there,
which costs reading that month's ids. The more ids a batch has, the more months it opens in vain, so
filters pay for batches that are small beside a month; of a batch as large as a month all are read.

A filter is a table of blocks of 256 bits. The low bits of an id's hash choose its block, two bits
in each of four words are set by another hash, and blocks of different tasks are merged by bitwise
or. Each month has as many blocks as its orders need, a power of two (`level`), and only those
that hold an order are rows. A batch meets them by an equi-join on level and block, so the filters
are dealt out like any other table; there are 2 ** LEAST_LEVEL blocks or more, so that no block
gathers a large share of a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import runs
from .parquet import MONTH

KEY = "order_id"
#: Orders in a block of 256 bits, on average at most, and the fewest blocks of a month: 2 ** this.
ORDERS_IN_BLOCK, LEAST_LEVEL = 10, 14
WORDS = 4
SCHEMA = "filter_month INT, level INT, block BIGINT, " + ", ".join(
    f"word{k} BIGINT" for k in range(WORDS)
)


def filter_folder(month_folder: str) -> str:
    """Where the filter of a month folder lies: beside the orders of the run that wrote it."""
    path, _, month = month_folder.rpartition("/")
    return f"{path}_filters/{month}"


def _level(orders: int) -> int:
    """The power of two of blocks that hold so many orders."""
    return max(LEAST_LEVEL, (-(-orders // ORDERS_IN_BLOCK) - 1).bit_length())


def _block(level: str = "level") -> Column:
    return F.expr(f"xxhash64({KEY}) & (shiftleft(1L, {level}) - 1)").alias("block")


def _words() -> list[Column]:
    """The bits of an id: two in each word, each chosen by six bits of a hash."""

    def bit(k: int) -> str:
        return f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64({KEY}, 1), {6 * k}) & 63 AS INT))"

    return [F.expr(f"{bit(2 * k)} | {bit(2 * k + 1)}").alias(f"word{k}") for k in range(WORDS)]


def filters_of(orders: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """The filters of orders with their MONTH, from how many orders each month has.

    A row for each block that holds an order; ids that are NULL are in no filter.
    """
    levels = orders.sparkSession.createDataFrame(
        [(month, _level(size)) for month, size in sizes.items()], f"{MONTH} INT, level INT"
    )
    return (
        orders.filter(F.col(KEY).isNotNull())
        .select(KEY, MONTH)
        # A row for each month, of which accepted timestamps have 7,000 at most.
        .join(F.broadcast(levels), MONTH)
        .select(F.col(MONTH).alias("filter_month"), "level", _block(), *_words())
        .groupBy("filter_month", "level", "block")
        .agg(*[F.bit_or(f"word{k}").alias(f"word{k}") for k in range(WORDS)])
    )


def write_filters(spark: SparkSession, path: str) -> list[int]:
    """Write the filters of the month folders below `path`; returns the months that are there."""
    orders = spark.read.parquet(path).select(KEY, MONTH)
    sizes = {row[MONTH]: row["count"] for row in orders.groupBy(MONTH).count().collect()}
    (
        filters_of(orders, sizes)
        .withColumn(MONTH, F.col("filter_month"))
        .hint("rebalance", MONTH)
        .write.mode("overwrite")
        .partitionBy(MONTH)
        .parquet(f"{path}_filters")
    )
    return sorted(sizes)


def months_of(filters: DataFrame, batch: DataFrame) -> set[int]:
    """The months whose filter has an id of the batch."""
    # Levels are powers of two of blocks: some forty at most.
    levels = sorted(row.level for row in filters.select("level").distinct().collect())
    if not levels:
        return set()
    asked = (
        batch.filter(F.col(KEY).isNotNull())
        .select(KEY, F.explode(F.array(*map(F.lit, levels))).alias("level"))
        .select("level", _block(), *[word.alias(f"bits{k}") for k, word in enumerate(_words())])
    )
    there = F.lit(True)
    for k in range(WORDS):
        there = there & (F.col(f"word{k}").bitwiseAND(F.col(f"bits{k}")) == F.col(f"bits{k}"))
    same = (filters["level"] == asked["level"]) & (filters["block"] == asked["block"])
    met = filters.join(asked, same & there, "left_semi")
    return {row.filter_month for row in met.select("filter_month").distinct().collect()}


def months_to_read(spark: SparkSession, months: dict[int, str], batch: DataFrame) -> set[int]:
    """The months that may hold an order of the batch; of `months`, the folder of each month.

    A month without a filter (one that an earlier version wrote) is always among them.
    """
    filters = {month: filter_folder(folder) for month, folder in months.items()}
    there: dict[str, set[str]] = {}
    for path in filters.values():
        top = path.rpartition("/")[0]
        if top not in there:
            there[top] = runs.subfolders(spark, top)
    known = {
        month: path
        for month, path in filters.items()
        if path.rpartition("/")[2] in there[path.rpartition("/")[0]]
    }
    if not known:
        return set(months)
    read = spark.read.schema(SCHEMA).parquet(*sorted(known.values()))
    return months_of(read, batch) | (months.keys() - known.keys())
