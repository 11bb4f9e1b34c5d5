
from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import proxy_inputs as inputs  # noqa: E402
from oracles import ORACLES  # noqa: E402
from orderledger.operators import (  # noqa: E402
    cleaning,
    frequent,
    inference,
    joins,
    merge,
    numbering,
    quality,
    reports,
    snapshots,
)
from orderledger.plans import daily_report, etl, revenue  # noqa: E402
from orderledger.schema import ITEM_COLUMNS  # noqa: E402
from orderledger.sources import (  # noqa: E402
    csv,
    layout,
    month_filters,
    parquet,
    quoted_csv,
    runs,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


ALL_ORACLES: dict[str, str] = dict(ORACLES)


def query(function):
    QUERIES[function.__name__] = function
    return function


def money_as_double(df: DataFrame) -> DataFrame:
    """Decimals shown as DOUBLE, the type the oracle returns."""
    money = [name for name, kind in df.dtypes if kind.startswith("decimal")]
    return df.withColumns({name: F.col(name).cast("double") for name in money})


def orders_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_orders(inputs.raw_orders(spark, sf_dir))


def items_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.narrow_items(cleaning.clean_items(inputs.raw_items(spark, sf_dir)))


def coerced_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with numbers parsed and no row dropped yet."""
    return cleaning.coerce_items(inputs.raw_items(spark, sf_dir))


# Sources and sinks


@query
def scan_csv_orders(spark, sf_dir):
    path = runs.new_path(spark, "raw_orders")
    csv.write_raw_csv(inputs.raw_orders(spark, sf_dir), path)
    return cleaning.normalize_null_tokens(csv.read_raw_orders(spark, path))


@query
def scan_csv_items(spark, sf_dir):
    path = runs.new_path(spark, "raw_items")
    csv.write_raw_csv(inputs.token_items(spark, sf_dir), path)
    return cleaning.normalize_null_tokens(csv.read_raw_items(spark, path))


@query
def scan_parquet_orders(spark, sf_dir):
    return parquet.read_parquet(spark, f"{sf_dir}/orders.parquet")


@query
def sink_parquet_roundtrip(spark, sf_dir):
    path = runs.new_path(spark, "orders_clean")
    parquet.write_parquet(orders_of(spark, sf_dir), path)
    return parquet.read_parquet(spark, path)


@query
def orders_between_dates(spark, sf_dir):
    path = runs.new_path(spark, "orders")
    stamped = cleaning.stamp_audit_columns(orders_of(spark, sf_dir), inputs.FIRST_RUN)
    parquet.write_orders_by_month(stamped, path)
    return parquet.read_orders_by_month(
        spark, path, date(1996, 2, 15), date(1999, 10, 3)
    )


@query
def reload_items(spark, sf_dir):
    path = runs.new_path(spark, "order_items")
    etl.reload_items(inputs.raw_items(spark, sf_dir), path, inputs.FIRST_RUN)
    etl.reload_items(inputs.raw_items(spark, sf_dir), path, inputs.SECOND_RUN)
    return money_as_double(parquet.read_parquet(spark, path).drop("id"))


@query
def sink_csv_report(spark, sf_dir):
    path = runs.new_path(spark, "report")
    daily_report.write_daily_report(orders_of(spark, sf_dir), items_of(spark, sf_dir), path)
    return csv.read_report(spark, path)


@query
def report_reconcile(spark, sf_dir):
    path = runs.new_path(spark, "report")
    orders, items = orders_of(spark, sf_dir), items_of(spark, sf_dir)
    days = daily_report.write_daily_report(orders, items, path)
    return money_as_double(
        reports.report_reconcile(csv.read_report(spark, path), days, orders, items)
    )


@query
def scan_csv_quoted(spark, sf_dir):
    path = runs.new_path(spark, "raw_items")
    csv.write_raw_csv(inputs.quoted_items(spark, sf_dir), path)
    return cleaning.normalize_null_tokens(quoted_csv.read_csv_quoted(spark, path, ITEM_COLUMNS))


@query
def infer_column_types(spark, sf_dir):
    tables = {
        "orders": inputs.raw_orders(spark, sf_dir),
        "order_items": inputs.raw_items(spark, sf_dir),
        "slashed_orders": inputs.slashed_timestamps(spark, sf_dir),
    }
    found = [
        inference.infer_column_types(df, 90).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def scan_csv_typed(spark, sf_dir):
    path = runs.new_path(spark, "raw_items")
    csv.write_raw_csv(inputs.raw_items(spark, sf_dir), path)
    raw = csv.read_raw_items(spark, path)
    types = inference.infer_column_types(raw, 90).collect()
    return money_as_double(inference.cast_columns(raw, types))


def _laid_out_items(spark, sf_dir):
    path = runs.new_path(spark, "items_by_order_and_product")
    layout.write_interleaved(items_of(spark, sf_dir), path, ["order_id", "product_id"], 64)
    return path


def _laid_out_orders(spark, sf_dir):
    path = runs.new_path(spark, "orders_by_customer_and_status")
    layout.write_interleaved(orders_of(spark, sf_dir), path, ["customer_id", "order_status"], 64)
    return path


@query
def items_of_product(spark, sf_dir):
    path = _laid_out_items(spark, sf_dir)
    return money_as_double(layout.rows_with(spark, path, "product_id", "10"))


@query
def items_of_order(spark, sf_dir):
    path = _laid_out_items(spark, sf_dir)
    return money_as_double(layout.rows_with(spark, path, "order_id", "7"))


@query
def orders_of_customer(spark, sf_dir):
    return layout.rows_with(spark, _laid_out_orders(spark, sf_dir), "customer_id", "10")


@query
def orders_of_status(spark, sf_dir):
    return layout.rows_with(spark, _laid_out_orders(spark, sf_dir), "order_status", "canceled")


@query
def snapshot_checksum(spark, sf_dir):
    tables = {"orders": orders_of(spark, sf_dir), "order_items": items_of(spark, sf_dir)}
    checked = []
    for name, df in tables.items():
        path = runs.new_path(spark, name)
        written = snapshots.write_checked(df, path)
        read = spark.read.parquet(path).agg(*snapshots.digest(sorted(df.columns)))
        equal = F.lit(True)
        for part, value in written.items():
            equal = equal & (F.col(part) == F.lit(value))
        rows = F.col("digest_rows").alias("row_count")
        checked.append(read.select(F.lit(name).alias("table_name"), rows, equal.alias("matches")))
    return checked[0].unionByName(checked[1])


@query
def changed_items(spark, sf_dir):
    before = items_of(spark, sf_dir)
    after = cleaning.narrow_items(cleaning.clean_items(inputs.reloaded_items(spark, sf_dir)))
    return money_as_double(snapshots.changed_rows(before, after))


# Cleaning


@query
def normalize_null_tokens(spark, sf_dir):
    return cleaning.normalize_null_tokens(inputs.token_items(spark, sf_dir))


@query
def parse_order_timestamps(spark, sf_dir):
    return cleaning.parse_order_timestamps(inputs.optional_timestamps(spark, sf_dir))


@query
def parse_timestamps_by_pattern(spark, sf_dir):
    slashed = inputs.slashed_timestamps(spark, sf_dir)
    return cleaning.parse_order_timestamps(slashed, "MM/dd/yyyy H:m:s")


@query
def fill_delivery_date(spark, sf_dir):
    parsed = cleaning.parse_order_timestamps(inputs.varied_timestamps(spark, sf_dir))
    return cleaning.fill_delivery_date(parsed)


@query
def narrow_orders(spark, sf_dir):
    return cleaning.narrow_orders(inputs.optional_timestamps(spark, sf_dir))


@query
def coerce_item_numbers(spark, sf_dir):
    return money_as_double(cleaning.coerce_items(inputs.varied_prices(spark, sf_dir)))


@query
def drop_bad_prices(spark, sf_dir):
    kept = cleaning.drop_bad_prices(coerced_of(spark, sf_dir))
    return money_as_double(kept.drop("price_issue", "freight_issue"))


@query
def drop_negative_prices(spark, sf_dir):
    kept = cleaning.drop_negative_prices(coerced_of(spark, sf_dir))
    return money_as_double(kept.drop("price_issue", "freight_issue"))


@query
def dropped_item_count(spark, sf_dir):
    return cleaning.dropped_item_counts(
        cleaning.coerce_items(inputs.varied_prices(spark, sf_dir))
    )


@query
def narrow_items(spark, sf_dir):
    return money_as_double(cleaning.narrow_items(coerced_of(spark, sf_dir)))


@query
def default_freight(spark, sf_dir):
    return money_as_double(cleaning.default_freight(items_of(spark, sf_dir)))


@query
def stamp_audit_columns(spark, sf_dir):
    return cleaning.stamp_audit_columns(orders_of(spark, sf_dir), inputs.SECOND_RUN)


@query
def surrogate_item_id(spark, sf_dir):
    # The ids depend on the partitioning, so what is compared is how many there are.
    return cleaning.surrogate_item_id(items_of(spark, sf_dir)).agg(
        F.count("*").alias("item_count"),
        F.count_distinct("id").alias("id_count"),
        F.count_if(F.col("id").isNull()).alias("missing_ids"),
    )


@query
def dense_item_ids(spark, sf_dir):
    loads = [
        items_of(spark, sf_dir),
        cleaning.narrow_items(cleaning.clean_items(inputs.reloaded_items(spark, sf_dir))),
    ]
    numbered, last = [], 0
    for number, items in enumerate(loads, 1):
        path = runs.new_path(spark, "items_to_number")
        ids = numbering.dense_ids(items, path, last, ITEM_COLUMNS)
        numbered.append(ids.select(F.lit(number).alias("load_number"), "*"))
        last += parquet.read_parquet(spark, path).count()
    return money_as_double(numbered[0].unionByName(numbered[1]))


@query
def clean_orders(spark, sf_dir):
    return orders_of(spark, sf_dir)


@query
def clean_items(spark, sf_dir):
    return money_as_double(cleaning.clean_items(inputs.varied_prices(spark, sf_dir)))


# Quality


@query
def duplicate_order_ids(spark, sf_dir):
    return quality.duplicate_order_ids(inputs.keyless_items(spark, sf_dir))


@query
def null_price_count(spark, sf_dir):
    return quality.null_price_count(coerced_of(spark, sf_dir))


@query
def negative_price_count(spark, sf_dir):
    return quality.negative_price_count(coerced_of(spark, sf_dir))


@query
def quality_orders(spark, sf_dir):
    return quality.quality_orders(inputs.flawed_orders(spark, sf_dir))


@query
def quality_items(spark, sf_dir):
    return quality.quality_items(coerced_of(spark, sf_dir))


@query
def quality_status_domain(spark, sf_dir):
    return quality.quality_status_domain(inputs.flawed_orders(spark, sf_dir))


@query
def quality_constraints(spark, sf_dir):
    return quality.quality_constraints(
        cleaning.clean_orders(inputs.broken_orders(spark, sf_dir)),
        cleaning.coerce_items(inputs.broken_items(spark, sf_dir)),
    )


@query
def quality_item_ids(spark, sf_dir):
    # Products stand for ids that repeat.
    return quality.unique_item_id(
        items_of(spark, sf_dir).select(F.col("product_id").cast("bigint").alias("id"))
    )


@query
def quality_foreign_key(spark, sf_dir):
    active = joins.active_orders(orders_of(spark, sf_dir))
    return quality.quality_foreign_key(items_of(spark, sf_dir), active)


# Joins and merge


@query
def heavy_order_ids(spark, sf_dir):
    return frequent.heavy_keys(inputs.skewed_items(spark, sf_dir), "order_id")


@query
def active_orders(spark, sf_dir):
    return joins.active_orders(cleaning.clean_orders(inputs.flawed_orders(spark, sf_dir)))


@query
def order_report_date(spark, sf_dir):
    return joins.order_report_date(orders_of(spark, sf_dir))


@query
def join_orders_items(spark, sf_dir):
    joined = joins.join_orders_items(orders_of(spark, sf_dir), items_of(spark, sf_dir))
    return money_as_double(joined)


@query
def join_using(spark, sf_dir):
    return money_as_double(
        joins.join_using(orders_of(spark, sf_dir), items_of(spark, sf_dir))
    )


@query
def orphan_items(spark, sf_dir):
    active = joins.active_orders(orders_of(spark, sf_dir))
    return money_as_double(joins.orphan_items(items_of(spark, sf_dir), active))


@query
def cascade_delete_items(spark, sf_dir):
    canceled = orders_of(spark, sf_dir).filter("order_status = 'canceled'")
    return money_as_double(joins.cascade_delete_items(items_of(spark, sf_dir), canceled))


@query
def upsert_orders(spark, sf_dir):
    target = cleaning.stamp_audit_columns(orders_of(spark, sf_dir), inputs.FIRST_RUN)
    batch = cleaning.clean_orders(inputs.batch_orders(spark, sf_dir))
    return merge.upsert_orders(target, batch, inputs.SECOND_RUN)


@query
def upsert_action_counts(spark, sf_dir):
    target = cleaning.stamp_audit_columns(orders_of(spark, sf_dir), inputs.FIRST_RUN)
    batch = cleaning.clean_orders(inputs.batch_orders(spark, sf_dir))
    return merge.upsert_action_counts(target, batch)


@query
def former_months(spark, sf_dir):
    path = runs.new_path(spark, "orders")
    parquet.write_orders_by_month(
        cleaning.stamp_audit_columns(orders_of(spark, sf_dir), inputs.FIRST_RUN), path
    )
    months = {
        month: parquet.month_folder(path, month)
        for month in month_filters.write_filters(spark, path)
    }
    batch = cleaning.clean_orders(inputs.batch_orders(spark, sf_dir))
    former = etl.former_months(spark, months, batch)
    return former.groupBy(parquet.MONTH).agg(F.count("*").alias("order_count"))


# Reports


@query
def daily_revenue_report(spark, sf_dir):
    return reports.daily_revenue_report(orders_of(spark, sf_dir), items_of(spark, sf_dir))


@query
def daily_revenue_view(spark, sf_dir):
    return reports.daily_revenue_view(orders_of(spark, sf_dir), items_of(spark, sf_dir))


@query
def daily_revenue_view_by_name(spark, sf_dir):
    root = runs.new_path(spark, "curated")
    _load_twice(spark, sf_dir, root)
    daily_report.create_revenue_view(spark, root)
    return spark.sql("SELECT * FROM v_daily_revenue")


def _in_output_order(df):
    """Rows with their numbers in the order in which they come out: one row for each day."""
    placed = df.withColumn("_at", F.monotonically_increasing_id())
    line = F.row_number().over(Window.orderBy("_at")).cast("bigint")
    return placed.select(line.alias("line_number"), *df.columns)


@query
def report_output_order(spark, sf_dir):
    path = runs.new_path(spark, "report")
    daily_report.write_daily_report(orders_of(spark, sf_dir), items_of(spark, sf_dir), path)
    return _in_output_order(csv.read_report(spark, path))


@query
def view_output_order(spark, sf_dir):
    return _in_output_order(
        reports.daily_revenue_view(orders_of(spark, sf_dir), items_of(spark, sf_dir))
    )


@query
def daily_revenue_incremental(spark, sf_dir):
    root = runs.new_path(spark, "curated")
    items = inputs.raw_items(spark, sf_dir), inputs.reloaded_items(spark, sf_dir)
    _load(spark, inputs.raw_orders(spark, sf_dir), items[0], root, inputs.FIRST_RUN)
    first, kept = runs.current_run(spark, root), runs.new_path(spark, "revenue_state")
    state = revenue.daily_state(
        etl.read_current_orders(spark, first), etl.read_current_items(spark, first)
    )
    parquet.write_parquet(state, kept)
    _load(spark, inputs.batch_orders(spark, sf_dir), items[1], root, inputs.SECOND_RUN)
    second, state = runs.current_run(spark, root), parquet.read_parquet(spark, kept)
    return revenue.view_of(revenue.refreshed_state(spark, state, first, second))


@query
def etl_row_counts(spark, sf_dir):
    orders, items = orders_of(spark, sf_dir), items_of(spark, sf_dir)
    counted = {
        "orders": orders,
        "order_items": items,
        "daily_report": reports.daily_revenue_report(orders, items),
    }
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "*")
        for name, df in counted.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# Whole jobs


def _load(spark, raw_orders, raw_items, root, run_ts):
    """One load from CSV files of the whole raw tables."""
    orders_csv, items_csv = runs.new_path(spark, "raw_orders"), runs.new_path(spark, "raw_items")
    csv.write_raw_csv(raw_orders, orders_csv)
    csv.write_raw_csv(raw_items, items_csv)
    return etl.run_etl(spark, orders_csv, items_csv, root, run_ts).run


def _load_twice(spark, sf_dir, root):
    """All orders, then a batch that changes their statuses and brings new ones."""
    items = inputs.raw_items(spark, sf_dir)
    _load(spark, inputs.raw_orders(spark, sf_dir), items, root, inputs.FIRST_RUN)
    _load(spark, inputs.batch_orders(spark, sf_dir), items, root, inputs.SECOND_RUN)


@query
def run_etl_orders(spark, sf_dir):
    root = runs.new_path(spark, "curated")
    _load_twice(spark, sf_dir, root)
    return etl.read_current_orders(spark, runs.current_run(spark, root))


@query
def run_etl_items(spark, sf_dir):
    root = runs.new_path(spark, "curated")
    raw = inputs.raw_orders(spark, sf_dir), inputs.raw_items(spark, sf_dir)
    run = _load(spark, *raw, root, inputs.SECOND_RUN)
    return money_as_double(parquet.read_parquet(spark, run.items_path).drop("id"))


@query
def daily_report_job(spark, sf_dir):
    root = runs.new_path(spark, "curated")
    raw = inputs.raw_orders(spark, sf_dir), inputs.raw_items(spark, sf_dir)
    run = _load(spark, *raw, root, inputs.FIRST_RUN)
    orders = parquet.read_parquet(spark, run.orders_clean_path)
    items = parquet.read_parquet(spark, run.items_path)
    path = runs.new_path(spark, "report")
    written = daily_report.write_checked_daily_report(orders, items, path)
    daily_report.verify_written_report(spark, path, written)
    return csv.read_report(spark, path)


# The operators for training text and their pipeline, if they are there


def _absent(error: ModuleNotFoundError, *names: str) -> None:
    """The operators are not there, or a package that they need is not: the others go on."""
    if error.name not in names and error.name.split(".")[0] in ("orderledger", "proxy_inputs"):
        raise error
    if error.name not in names:
        warnings.warn(f"no queries for training text: {error}", stacklevel=2)


try:
    from orderledger.llm import queries as llm_queries

    QUERIES.update(llm_queries.QUERIES)
    ALL_ORACLES.update(llm_queries.ORACLES)
except ModuleNotFoundError as error:
    _absent(error, "orderledger.llm")

try:
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        ALL_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
except ModuleNotFoundError as error:
    _absent(error, "corpus_pipeline", "orderledger.llm")


def entry(spark: SparkSession) -> DataFrame:
    """The daily revenue report on the smallest tables."""
    return QUERIES["daily_revenue_report"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ALL_ORACLES)
