"""JDBC tables, read over several connections and written in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per round trip, reading and writing.
ROWS_PER_TRIP = 10_000


def key_range_options(
    column: str, lower: int | None, upper: int | None, partitions: int
) -> dict[str, str]:
    """Options that split a scan by ranges of a numeric column.

    The bounds only place the cuts: rows outside them are read too. An empty table has no
    bounds and is not split.
    """
    if lower is None or upper is None:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    connection: dict[str, str],
    split: dict[str, str] | None = None,
) -> DataFrame:
    """A table (name it with its schema); without ``split`` it is read by one task."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, fetchsize=str(ROWS_PER_TRIP))
        .options(**connection)
        .options(**(split or {}))
        .load()
    )


def key_bounds(
    spark: SparkSession, url: str, table: str, column: str, connection: dict[str, str]
) -> tuple[int | None, int | None]:
    """Least and greatest key, computed by the database; None for an empty table."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = (
        spark.read.format("jdbc")
        .options(url=url, query=query)
        .options(**connection)
        .load()
        .first()
    )
    return row["lo"], row["hi"]


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    connection: dict[str, str],
    mode: str = "overwrite",
    connections: int = 16,
) -> None:
    """Insert in batches over a bounded number of connections.

    An overwrite empties the table and keeps its constraints.
    """
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, truncate="true")
        .options(batchsize=str(ROWS_PER_TRIP), numPartitions=str(connections))
        .options(**connection)
        .mode(mode)
        .save()
    )
