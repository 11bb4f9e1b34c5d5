"""Bloom filters of order ids by month."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderledger.plans import etl
from orderledger.schema import CURATED_ORDERS
from orderledger.sources import month_filters, parquet

MONTHS = [(2020 + k // 12, k % 12 + 1) for k in range(30)]
NOW = datetime(2024, 1, 1)


def ids(spark, keys):
    return spark.createDataFrame([(key,) for key in keys], "order_id STRING")


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    """Thirty months of 200 orders, and where each lies."""
    rows = [
        (f"{year}-{month}-{n}", "c", "created", datetime(year, month, 1 + n % 28), None, NOW, NOW)
        for year, month in MONTHS
        for n in range(200)
    ]
    path = f"{tmp_path_factory.mktemp('curated')}/orders"
    parquet.write_orders_by_month(spark.createDataFrame(rows, CURATED_ORDERS), path)
    written = month_filters.write_filters(spark, path)
    assert written == [year * 100 + month for year, month in MONTHS]
    return {month: parquet.month_folder(path, month) for month in written}


def test_no_month_is_missed_and_few_are_opened_in_vain(spark, months):
    for year, month in MONTHS[::7]:
        known = ids(spark, [f"{year}-{month}-{n}" for n in range(0, 200, 9)])
        found = month_filters.months_to_read(spark, months, known)
        assert year * 100 + month in found and len(found) <= 2
    unknown = ids(spark, [f"new-{n}" for n in range(100)])
    assert len(month_filters.months_to_read(spark, months, unknown)) <= 1


def test_former_months_opens_only_those(spark, months):
    batch = ids(spark, ["2020-3-5", "2021-11-199", "2021-11-0", "new", None])
    former = etl.former_months(spark, months, batch)
    assert sorted(map(tuple, former.collect())) == [
        ("2020-3-5", 202003),
        ("2021-11-0", 202111),
        ("2021-11-199", 202111),
    ]
    opened = {part.rpartition("/")[0].rpartition("=")[2] for part in former.inputFiles()}
    assert {"202003", "202111"} <= opened and len(opened) <= 3


def test_a_large_batch_reads_all_ids_and_asks_no_filter(spark, months, monkeypatch):
    keys = [f"{year}-{month}-{n}" for year, month in MONTHS[:20] for n in range(0, 200, 2)]
    batch = ids(spark, [*keys, "new", None])
    monkeypatch.setattr(month_filters, "months_of", None)
    former = etl.former_months(spark, months, batch)
    assert sorted(r.order_id for r in former.collect()) == sorted(keys)


def test_a_month_without_a_filter_is_read(spark, months, tmp_path):
    path = str(tmp_path / "orders")
    row = ("old", "c", "created", datetime(2019, 5, 1), None, NOW, NOW)
    parquet.write_orders_by_month(spark.createDataFrame([row], CURATED_ORDERS), path)
    mixed = months | {201905: parquet.month_folder(path, 201905)}
    assert 201905 in month_filters.months_to_read(spark, mixed, ids(spark, ["new"]))
    former = etl.former_months(spark, mixed, ids(spark, ["old", "2020-1-0"]))
    assert sorted(map(tuple, former.collect())) == [("2020-1-0", 202001), ("old", 201905)]
    assert month_filters.months_to_read(spark, {}, ids(spark, ["new"])) == set()


def test_an_empty_batch_opens_nothing(spark, months):
    assert month_filters.months_to_read(spark, months, ids(spark, [])) == set()


@pytest.mark.parametrize(
    ("orders", "level"),
    [(0, 14), (163_840, 14), (163_841, 15), (327_680, 15), (327_681, 16), (10**9, 27)],
)
def test_blocks_grow_with_the_month(orders, level):
    assert month_filters._level(orders) == level


def test_wrong_answers_are_rare_in_a_full_filter(spark):
    # As many orders as 2 ** 14 blocks take, in each of four months.
    keys = spark.range(4 * 163_840).select(
        F.concat(F.lit("k"), "id").alias("order_id"), (F.col("id") % 4).cast("int").alias("m")
    )
    orders = keys.withColumnRenamed("m", parquet.MONTH)
    filters = month_filters.filters_of(orders, {m: 163_840 for m in range(4)}).cache()
    assert filters.agg(F.max("level")).first()[0] == 14
    assert month_filters.months_of(filters, keys.filter("m = 2").select("order_id")) >= {2}
    wrong = 0
    for part in range(20):  # 20 batches of 50 ids that are not there, asked of four filters
        asked = spark.range(50).select(F.concat(F.lit(f"x{part}-"), "id").alias("order_id"))
        wrong += len(month_filters.months_of(filters, asked))
    filters.unpersist()
    assert wrong <= 8  # of 4,000 questions: one in a thousand would be 4


def test_filters_of_tasks_merge_by_or(spark):
    orders = ids(spark, [f"k{n}" for n in range(500)]).withColumn(parquet.MONTH, F.lit(202001))
    rows = [
        sorted(map(tuple, month_filters.filters_of(orders.repartition(n), {202001: 500}).collect()))
        for n in (1, 7)
    ]
    assert rows[0] == rows[1] and len(rows[0]) <= 500
