"""Tables laid out for lookups by several columns: interleaved ranges and a manifest of their bounds.

Each column's values have a hash; the upper bits of the columns' hashes, interleaved, order the rows,
and ranges of that order become files. So each file holds a small interval of every column's hashes,
which the manifest keeps, and a lookup by any of the columns opens only the files whose interval
covers the value: with two columns about the square root of them. A value with a third of the rows
is spread by the bits of the other columns, and equal rows by their place in the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of each column's hash that go into the order.
BITS = 12


def value_hash(value: Column) -> Column:
    """Not negative, so that the upper bits order like the hash; NULL is a value of its own."""
    return F.xxhash64(value, value.isNull()).bitwiseAND(F.lit((1 << 63) - 1))


def interleaved(hashes: list[Column], bits: int = BITS) -> Column:
    """The upper bits of the hashes, a bit of each in turn, the highest ones first."""
    order = F.lit(0).cast("bigint")
    for bit in range(bits):
        for value in hashes:
            digit = F.shiftright(value, 62 - bit).bitwiseAND(F.lit(1).cast("bigint"))
            order = order * 2 + digit
    return order


def write_interleaved(df: DataFrame, path: str, columns: list[str], files: int) -> None:
    """Write a table in `files` ranges of the interleaved order, and its manifest."""
    hashes = {f"_hash_{name}": value_hash(F.col(name)) for name in columns}
    ordered = df.withColumns(hashes).withColumns(
        {
            "_order": interleaved([F.col(name) for name in hashes]),
            "_tie": F.monotonically_increasing_id(),
        }
    )
    (
        ordered.repartitionByRange(files, "_order", "_tie")
        .drop("_order", "_tie")
        .write.mode("overwrite")
        .parquet(f"{path}/data")
    )
    written = df.sparkSession.read.parquet(f"{path}/data")
    bounds = [
        part
        for name in columns
        for part in (
            F.min(f"_hash_{name}").alias(f"least_{name}"),
            F.max(f"_hash_{name}").alias(f"most_{name}"),
        )
    ]
    # A row for each file.
    written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), *bounds
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def files_with(spark: SparkSession, path: str, column: str, value) -> list[str]:
    """The files whose interval covers the value."""
    wanted = value_hash(F.lit(value))
    covered = wanted.between(F.col(f"least_{column}"), F.col(f"most_{column}"))
    manifest = spark.read.parquet(f"{path}/manifest")
    return [row.file for row in manifest.filter(covered).select("file").collect()]


def rows_with(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """The rows whose column has the value; NULL finds NULLs. Only files that may have it are read."""
    data = spark.read.parquet(f"{path}/data")
    files = files_with(spark, path, column, value)
    rows = spark.read.schema(data.schema).parquet(*files) if files else data.limit(0)
    kept = [name for name in data.columns if not name.startswith("_hash_")]
    return rows.filter(F.col(column).eqNullSafe(F.lit(value))).select(kept)
