"""Dense ids that go on from the last one, without a global window.

Rows are written with their place (the writing task and the row's number in it), each task's rows are
counted, and a running sum over the tasks, a row each, gives every task its first id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import parquet

#: An increasing id is the task's number and, in so many lower bits, the row's place in it.
PLACE_BITS = 33


def dense_ids(
    df: DataFrame, path: str, after: int = 0, order: list[str] | None = None
) -> DataFrame:
    """`id` from `after` + 1 on, one for each row without gap or repeat, and the row's columns.

    The rows are written to `path` and the ids follow their order there. With `order` they are range
    partitioned and sorted by these columns first: if these make up the whole row, the ids do not
    depend on how the rows were dealt, as rows that tie are equal. A key with a third of the rows is
    split among ranges by the rows' places in the input. Rerun from the files, ids stay the same.
    """
    rows = df
    if order:
        rows = df.withColumn("_tie", F.monotonically_increasing_id())
        rows = rows.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    parquet.write_parquet(rows.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), path)
    placed = parquet.read_parquet(df.sparkSession, path).withColumn(
        "_task", F.shiftright("_at", PLACE_BITS)
    )
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_task").agg(F.count("*").alias("_n")).select(
        "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    # One row for each task that wrote, so it goes to every task.
    return placed.join(F.broadcast(starts), "_task").select(
        (F.lit(after + 1) + F.col("_before") + place).cast("bigint").alias("id"),
        *(F.col(f"`{name}`") for name in df.columns),
    )
