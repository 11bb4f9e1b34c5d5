"""One batch, from raw CSV to curated tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import MONEY_ISSUES, OUT_OF_RANGE
from ..operators import cleaning, merge, numbering, quality
from ..sources import csv, month_filters, parquet, runs

#: A batch with one order for so many known ones does not ask the months' filters.
LARGE_BATCH = 4


@dataclass(frozen=True)
class EtlResult:
    run: Row
    order_rows: int
    item_rows: int
    dropped_items: dict[str, int]
    checks: list[Row]


def read_current_orders(spark: SparkSession, run: Row | None) -> DataFrame:
    months = {} if run is None else run.order_months
    return parquet.read_month_folders(spark, sorted(months.values()))


def read_current_items(spark: SparkSession, run: Row) -> DataFrame:
    return parquet.read_parquet(spark, run.items_path)


def reload_items(
    raw_items: DataFrame, path: str, run_ts: datetime, after: int = 0
) -> tuple[dict[str, int], list[Row]]:
    """Clean the items and write them as the whole new item table.

    Returns the rows kept and dropped, and the range checks passed. A scan, a projection and a
    write, without a shuffle; then the rows get their ids, dense and going on from the last one of
    the load before (`after`), which is a second pass over what was written, beside `path`. Everything is counted while it passes: the counts sit in the
    stage that writes, where Spark counts every task once, however often it is retried. An
    amount beyond the curated column raises, and what is at ``path`` then is not for use. An
    empty batch gives an empty table.
    """
    counts = Observation()
    coerced = cleaning.coerce_items(raw_items).observe(
        counts,
        *[F.count_if(F.col("price_issue") == issue).alias(issue) for issue in MONEY_ISSUES],
        F.count_if(F.col("price_issue").isNull()).alias("kept"),
        F.count_if(F.col("price_issue") == OUT_OF_RANGE).alias("price_range"),
        F.count_if(
            (F.col("freight_issue") == OUT_OF_RANGE)
            & F.coalesce(F.col("price_issue") == OUT_OF_RANGE, F.col("price_issue").isNull())
        ).alias("freight_value_range"),
    )
    clean = cleaning.narrow_counted_items(cleaning.drop_unusable_items(coerced))
    stamped = cleaning.stamp_audit_columns(clean, run_ts, ("created_at",))
    curated = numbering.dense_ids(stamped, f"{path}_unnumbered", after)
    parquet.write_parquet(curated, path)
    found = counts.get
    checks = quality.enforce(quality.range_checks(found))
    return {name: found[name] for name in ["kept", *MONEY_ISSUES] if name != OUT_OF_RANGE}, checks


def former_months(spark: SparkSession, months: dict[int, str], batch: DataFrame) -> DataFrame:
    """The batch's orders that are known so far, and the month where each lies.

    Ids are read in the months whose filter has one of the batch's, and in no others. Filters are not
    asked by a batch that is large beside all months: its ids would be dealt out to ask, and again to
    be met with those of the months that it opens.
    """
    known = parquet.read_month_folders(spark, sorted(months.values())).count()
    if batch.count() * LARGE_BATCH >= known:
        open_months = set(months)
    else:
        open_months = month_filters.months_to_read(spark, months, batch)
    target = parquet.read_month_folders(spark, [months[month] for month in sorted(open_months)])
    return target.select("order_id", parquet.month_of_purchase()).join(
        batch.select("order_id"), "order_id", "left_semi"
    )


def merge_by_month(
    spark: SparkSession,
    months: dict[int, str],
    batch: DataFrame,
    path: str,
    run_ts: datetime,
    checked: bool = False,
) -> dict[int, str]:
    """Merge a batch into orders that lie in month folders; returns the folder of each month.

    Rewritten are the months of the batch and those where its orders were so far, found by the
    months' filters and a scan of ids where these say so. The other months' files stay as they are.
    An order that moves to another month leaves its old one, since both are rewritten; a month that
    is left empty has no folder any more. The rewritten months get new filters, from the ids as
    written. ``checked``: see `merge.upsert_orders`.
    """
    former = former_months(spark, months, batch)
    now = batch.select("order_id", parquet.month_of_purchase())
    touched = former.unionByName(now).select(parquet.MONTH).distinct().collect()
    rewritten = {row[parquet.MONTH] for row in touched}  # a number for each month at most
    old = parquet.read_month_folders(
        spark, [folder for month, folder in sorted(months.items()) if month in rewritten]
    )
    merged = merge.upsert_orders(old, batch, run_ts, checked)
    parquet.write_orders_by_month(merged, path)
    left = {month: folder for month, folder in months.items() if month not in rewritten}
    if rewritten:
        for month in month_filters.write_filters(spark, path):
            left[month] = parquet.month_folder(path, month)
    return dict(sorted(left.items()))


def run_etl(
    spark: SparkSession,
    orders_csv: str,
    items_csv: str,
    root: str,
    run_ts: datetime,
    multi_line: bool = False,
    pattern: str | None = None,
) -> EtlResult:
    """Clean, check, merge the orders, reload the items, then make the run current.

    The checks read the files just written, which costs a scan but neither a second
    cleaning nor a cache. Nothing under ``root`` is current until the last line, so a
    violation leaves the former tables in place.
    """
    previous = runs.current_run(spark, root)
    folder = runs.new_run_folder(root, run_ts)
    clean_path, orders_path, items_path = (
        f"{folder}/{name}" for name in ["orders_clean", "orders", "order_items"]
    )

    raw_orders = csv.read_raw_orders(spark, orders_csv, multi_line)
    rows = Observation()
    clean = cleaning.clean_orders(raw_orders, pattern).observe(rows, F.count("*").alias("rows"))
    parquet.write_parquet(clean, clean_path)
    batch = parquet.read_parquet(spark, clean_path)
    checks = quality.enforce(quality.load_checks_orders(batch))

    raw_items = csv.read_raw_items(spark, items_csv, multi_line)
    last_id = 0 if previous is None else previous.last_item_id or 0
    counts, in_range = reload_items(raw_items, items_path, run_ts, last_id)
    items = parquet.read_parquet(spark, items_path)
    checks += in_range + quality.enforce(quality.load_checks_items(items))

    months = {} if previous is None else previous.order_months
    # The gate has found each key of these files there once.
    months = merge_by_month(spark, months, batch, orders_path, run_ts, checked=True)
    orders = parquet.read_month_folders(spark, sorted(months.values()))
    checks += quality.enforce(quality.quality_foreign_key(items, orders))

    last_id += counts["kept"]
    run = runs.commit_run(spark, root, previous, run_ts, clean_path, months, items_path, last_id)
    return EtlResult(
        run=run,
        order_rows=rows.get["rows"],
        item_rows=counts.pop("kept"),
        dropped_items=counts,
        checks=checks,
    )
