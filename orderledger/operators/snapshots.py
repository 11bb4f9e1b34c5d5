"""Digests of whole tables that do not depend on the order of rows, and what two tables differ in.

A row has two 64-bit hashes of its cells, with NULLs told from what they stand beside; a table's
digest is their sums modulo 2^64 and the number of rows. Sums take repeated rows into account and
add up over tasks, buckets and files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Buckets of rows whose digests two tables are compared by.
BUCKETS = 4096
MODULUS = "18446744073709551616"


class SnapshotMismatch(ValueError):
    """A table read back is not the one that was written."""


def row_hash(columns: list[str], seed: int = 0) -> Column:
    parts = [part for n in columns for part in (F.col(f"`{n}`"), F.col(f"`{n}`").isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def digest(columns: list[str]) -> list[Column]:
    """Aggregates `digest_rows`, `digest_low` and `digest_high` of the rows."""

    def total(seed: int) -> Column:
        added = F.sum(row_hash(columns, seed).cast("decimal(20,0)"))
        return F.pmod(F.coalesce(added, F.lit(0)).cast("decimal(38,0)"), F.lit(MODULUS).cast(
            "decimal(38,0)"
        )).cast("decimal(20,0)")

    return [
        F.count("*").alias("digest_rows"),
        total(0).alias("digest_low"),
        total(1).alias("digest_high"),
    ]


def checksum(df: DataFrame) -> dict:
    """The digest of a table; the columns count by name."""
    return df.agg(*digest(sorted(df.columns))).first().asDict()


def write_checked(df: DataFrame, path: str) -> dict:
    """Write a table and return the digest of what went by; a retried task counts once."""
    seen = Observation()
    df.observe(seen, *digest(sorted(df.columns))).write.mode("overwrite").parquet(path)
    return seen.get


def verify(spark: SparkSession, path: str, expected: dict) -> None:
    found = checksum(spark.read.parquet(path))
    if found != expected:
        raise SnapshotMismatch(f"{path}: {found} instead of {expected}")


def _bucket(columns: list[str]) -> Column:
    return F.pmod(row_hash(columns, 2), F.lit(BUCKETS)).cast("int").alias("_bucket")


def unequal_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """`_bucket` of the buckets whose rows are not the same, BUCKETS rows at most."""
    columns = sorted(before.columns)

    def digests(df: DataFrame, name: str) -> DataFrame:
        found = df.groupBy(_bucket(columns)).agg(*digest(columns))
        return found.select("_bucket", F.struct(F.col("digest_rows"), "digest_low", "digest_high").alias(name))

    both = digests(before, "old").join(digests(after, "new"), "_bucket", "full_outer")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select("_bucket")


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """`change` ("added" or "removed"), `copies` and the columns of every row that is in only one.

    Rows count as often as they are there: `copies` is by how many the sides differ. Only rows in
    buckets whose digests differ are compared; they are combined before the shuffle, so that a row
    with many copies is one row for each task.
    """
    columns = before.columns
    by_name = sorted(columns)
    buckets = F.broadcast(unequal_buckets(before, after))  # BUCKETS rows at most

    def signed(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*(F.col(f"`{n}`") for n in columns), _bucket(by_name))
        return rows.join(buckets, "_bucket", "left_semi").drop("_bucket").withColumn(
            "_sign", F.lit(sign).cast("bigint")
        )

    both = signed(before, -1).unionByName(signed(after, 1))
    counted = both.groupBy(*(F.col(f"`{n}`") for n in columns)).agg(F.sum("_sign").alias("_n"))
    return counted.filter("_n <> 0").select(
        F.when(F.col("_n") > 0, "added").otherwise("removed").alias("change"),
        F.abs("_n").alias("copies"),
        *(F.col(f"`{n}`") for n in columns),
    )
