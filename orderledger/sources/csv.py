"""CSV files: raw input and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import snapshots
from ..schema import ITEM_COLUMNS, ORDER_COLUMNS

MISFIT = "_row_of_another_shape"
REPORT_SCHEMA = "report_date DATE, daily_revenue DOUBLE, order_count BIGINT"


def _refuse_open_quotes(spark: SparkSession, path: str) -> None:
    """A line whose quotes do not pair off may be half of a row with a line break in a cell."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    some = F.col("value").contains('"')  # most lines have none and are not counted
    broken = spark.read.text(path).filter(some & (quotes % 2 == 1)).select("value").head(1)
    if broken:
        raise ValueError(
            f"{path}: a line has a quote without its partner, so a cell may hold a line break; "
            f"read it with multi_line=True: {broken[0].value[:200]}"
        )


def _cells(line: Column) -> Column:
    """How many cells a line has: separators outside quotes, and one."""
    bare = F.regexp_replace(line, '"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_csv(
    spark: SparkSession, path: str, required: list[str], multi_line: bool = False
) -> DataFrame:
    """Raw cells as strings, bound by header name.

    A row with too few cells is filled with NULL, one with too many fails the job, and every
    file's header is compared with the first one's. Files are split into tasks at line breaks, so
    a line with an open quote is refused, which takes a scan of the text beforehand.
    ``multi_line`` reads line breaks inside quotes instead, and makes each file one task.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("columnPruning", False)  # else cells beyond the selected ones go unseen
    )
    header = reader.csv(path).schema
    absent = [name for name in required if name not in header.names]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    if not multi_line:
        _refuse_open_quotes(spark, path)
    raw = (
        reader.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MISFIT)
        .schema(T.StructType(header.fields + [T.StructField(MISFIT, T.StringType())]))
        .csv(path)
    )
    return without_misfits(raw, header.names)


def without_misfits(raw: DataFrame, header: list[str]) -> DataFrame:
    """The rows without MISFIT; one with more cells than the header fails the job."""
    # Only rows of another shape carry their text. The message names a cell too, since Spark
    # refuses to read that text alone.
    too_long = F.when(
        _cells(F.col(MISFIT)) > len(header),
        F.raise_error(F.concat_ws(" ", F.lit("too many cells at"), header[0], MISFIT)),
    )
    return raw.filter(too_long.isNull()).drop(MISFIT)


def read_raw_orders(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, ORDER_COLUMNS, multi_line)


def read_raw_items(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, ITEM_COLUMNS, multi_line)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Text cells as they are: the writer trims blanks unless told not to."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_checked_report(report: DataFrame, path: str) -> dict:
    """The report as one CSV file in date order; returns the digest of the rows that went by.

    The report has one row per day, so one task can write it. ``repartition`` rather
    than ``coalesce``: the latter would pull the final aggregation into that task too.
    The digest is taken in the writing stage, where a retried task counts once.
    """
    written = Observation()
    (
        report.repartition(1)
        .sortWithinPartitions(F.asc_nulls_first("report_date"))
        .observe(written, *snapshots.digest(sorted(report.columns)))
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
    return written.get


def write_report(report: DataFrame, path: str) -> int:
    """The report as one CSV file in date order; returns its number of days."""
    return write_checked_report(report, path)["digest_rows"]


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(REPORT_SCHEMA).csv(path)
