"""CSV files with line breaks inside quotes, read by many tasks.

Where a row begins depends on the quotes before it, which a task in the middle of a file has not
seen. But it takes only their parity: the files are read as lines, in byte ranges; lines are dealt to
pieces of a range, and each piece tells its number of quotes and where its last row begins, for
either parity. A running sum over the pieces of a file (a row each) gives each piece its parity, and
with it the place of every row's first line. Most rows are one line; the lines of the others meet by
that place, across the edges of pieces and ranges.

The text is read once, into a table of numbered lines; of this the pieces' sums read three columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import runs
from .csv import MISFIT, without_misfits
from .parquet import read_parquet, write_parquet

#: Lines of a piece.
PIECE = 4096
#: A row's place in its partition: the lower bits of Spark's increasing ids.
IN_PARTITION = (1 << 33) - 1
PLACE = ["file", "block", "piece"]
OPTIONS = {
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MISFIT,
}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The files' lines in pieces, with the quotes of the piece that come before each line."""
    line_no = F.monotonically_increasing_id()
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        line_no.alias("line_no"),
        "value",
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    numbered = runs.new_path(spark, "csv_lines")
    write_parquet(
        lines.withColumns(
            {
                "piece": F.expr(f"(line_no & {IN_PARTITION}L) div {PIECE}"),
                "quotes": quotes.cast("bigint"),
                "returns": F.col("value").endswith("\r"),
            }
        ),
        numbered,
    )
    upto = Window.partitionBy(PLACE).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return read_parquet(spark, numbered).withColumns(
        {
            "before": F.sum("quotes").over(upto) - F.col("quotes"),
            "number": F.count("*").over(upto),
        }
    )


def _pieces(lines: DataFrame) -> DataFrame:
    """For each piece: whether it begins inside quotes, and where the row begins that reaches into it."""
    odd = F.col("before") % 2 == 1
    pieces = lines.groupBy(PLACE).agg(
        F.sum("quotes").alias("quotes"),
        F.max(F.when(F.col("number") == 1, F.col("returns"))).alias("returns"),
        F.max(F.when(~odd, F.col("line_no"))).alias("last_if_closed"),
        F.max(F.when(odd, F.col("line_no"))).alias("last_if_open"),
    )
    in_file = Window.partitionBy("file")
    order = in_file.orderBy("block", "piece")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    opened = pieces.withColumns(
        {
            "open": F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2,
            "unpaired": F.sum("quotes").over(in_file) % 2 == 1,
            "first": F.row_number().over(order) == 1,
            # A file whose header ends with both characters has such line ends.
            "returns": F.first("returns").over(order),
        }
    )
    last = F.when(F.col("open") == 0, F.col("last_if_closed")).otherwise(F.col("last_if_open"))
    begun = F.when(last.isNotNull(), F.struct("block", last.alias("line_no")))
    reaches = F.last(begun, ignorenulls=True).over(earlier)
    kept = ["open", "unpaired", "first", F.col("returns").alias("crlf")]
    return opened.select(*PLACE, *kept, reaches.alias("reaches"))


def _rows(lines: DataFrame) -> DataFrame:
    """file, first (whether it is the file's header) and value of every row."""
    upto = Window.partitionBy(PLACE).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    begins = (F.col("before") + F.col("open")) % 2 == 0
    here = F.when(F.col("begins"), F.struct("block", "line_no"))
    refused = F.raise_error(F.concat(F.lit("a quote has no partner in "), F.col("file")))
    placed = (
        lines.join(_pieces(lines), PLACE)
        .withColumn("begins", begins)
        .withColumn("begin", F.coalesce(F.last(here, ignorenulls=True).over(upto), "reaches"))
        .withColumn("file", F.when(F.col("unpaired"), refused).otherwise(F.col("file")))
    )
    whole = F.col("begins") & (F.col("quotes") % 2 == 0)
    header = F.col("first") & (F.col("number") == 1)
    part = F.struct("block", "line_no", "value")
    broken = (
        placed.filter(~whole)
        .groupBy("file", "begin")
        .agg(
            F.array_sort(F.collect_list(part)).alias("parts"),
            F.max(header).alias("first"),
            F.max("crlf").alias("crlf"),
        )
        .select("file", "first", "crlf", F.array_join(F.col("parts.value"), "\n").alias("value"))
    )
    single = placed.filter(whole).select("file", header.alias("first"), "crlf", "value")
    # Spark's reader turns a file's line ends inside cells into line feeds, too.
    plain = F.regexp_replace(F.regexp_replace("value", "\r\n", "\n"), "\r\\z", "")
    return single.unionByName(broken).select(
        "file", "first", F.when(F.col("crlf"), plain).otherwise(F.col("value")).alias("value")
    )


def _parsed(value: Column, names: list[str]) -> Column:
    schema = ", ".join(f"`{name}` STRING" for name in [*names, MISFIT])
    return F.from_csv(value, schema, OPTIONS)


def read_csv_quoted(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Raw cells as strings, bound by header name; line breaks inside quotes belong to the cell.

    The same rows as one task for each file reads with Spark's `multiLine`. Quotes have to pair off in
    each file, so a single one inside a cell has to be doubled and quoted; a header is one line and
    the same in all files. Short rows are filled with NULL, long ones fail the job.
    """
    header = spark.read.option("header", True).option("escape", '"').csv(path).schema.names
    absent = [name for name in required if name not in header]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    rows = _rows(_lines(spark, path)).filter("value <> ''")
    plain = [f"c{k}" for k in range(len(header))]
    cells = rows.select("file", "first", F.inline(F.array(_parsed(F.col("value"), plain))))
    other = F.lit(False)
    for cell, name in zip(plain, header):
        other = other | ~F.col(cell).eqNullSafe(F.lit(name))
    # One condition, so that nothing filters headers out before they are looked at.
    refused = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    data = cells.filter(F.when(F.col("first"), F.when(other, refused).otherwise(False)).otherwise(True))
    named = data.select(*(F.col(c).alias(name) for c, name in zip(plain, header)), MISFIT)
    return without_misfits(named, header)
