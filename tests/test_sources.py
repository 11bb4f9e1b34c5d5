"""CSV binding and refusal, month layout, JDBC options, the run log."""

import tempfile
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from orderledger.operators import cleaning
from orderledger.schema import CLEAN_ORDERS
from orderledger.sources import csv, jdbc, parquet, runs

DAY = datetime(2024, 1, 1)


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, text in files.items():
            (tmp_path / f"{name}.csv").write_text(text)
        return str(tmp_path)

    return write


@pytest.mark.parametrize("multi_line", [True, False])
def test_columns_bind_by_name(spark, folder, multi_line):
    path = folder(a="x,price,order_id,y,freight_value,product_id\n1,2,007,4,5,p\n")
    row = csv.read_raw_items(spark, path, multi_line).first()
    assert (row.order_id, row.product_id, row.price, row.freight_value) == ("007", "p", "2", "5")


def test_quotes_and_line_breaks(spark, folder):
    path = folder(a='order_id,product_id,price,freight_value\n1,"a ""q""\nb, c",2,3\n')
    assert csv.read_raw_items(spark, path, multi_line=True).first().product_id == 'a "q"\nb, c'
    with pytest.raises(ValueError, match="multi_line=True"):
        csv.read_raw_items(spark, path)


def test_missing_column_is_an_error(spark, folder):
    with pytest.raises(ValueError, match="freight_value"):
        csv.read_raw_items(spark, folder(a="order_id,product_id,price\n1,2,3\n"))


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("columns", [["order_id"], ["order_id", "price"], []])
@pytest.mark.parametrize("row", ["1,2,3,4,5", "1,2,3,4,", '1,"a,b",3,4,"c,""d"'])
def test_long_rows_fail_whatever_is_read(spark, folder, multi_line, columns, row):
    path = folder(a=f"order_id,product_id,price,freight_value\n1,2,3,4\n{row}\n")
    raw = csv.read_raw_items(spark, path, multi_line)
    with pytest.raises(Exception, match="MALFORMED|too many cells"):
        raw.select(columns).collect() if columns else raw.count()


@pytest.mark.parametrize("multi_line", [True, False])
def test_short_rows_are_filled(spark, folder, multi_line):
    path = folder(a='order_id,product_id,price,freight_value\n1,2,3,4\n5,"x,y"\n6\n')
    rows = csv.read_raw_items(spark, path, multi_line).collect()
    assert [tuple(r) for r in rows] == [
        ("1", "2", "3", "4"), ("5", "x,y", None, None), ("6", None, None, None)
    ]


def test_halves_that_look_like_rows_are_refused(spark, folder):
    path = folder(a='order_id,product_id,price,freight_value\n1,2,3,"x\n5,6,7,y"\n')
    with pytest.raises(ValueError, match="multi_line=True"):
        csv.read_raw_items(spark, path)
    row = csv.read_raw_items(spark, path, multi_line=True).first()
    assert row.freight_value == "x\n5,6,7,y"


def test_a_large_file_is_split_by_default(spark, folder):
    lines = "\n".join(f"{n},product,1.50,0.10" for n in range(20000))
    path = folder(a=f"order_id,product_id,price,freight_value\n{lines}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        raw = csv.read_raw_items(spark, path)
        assert raw.rdd.getNumPartitions() > 4
        assert raw.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_with_another_column_order_fail(spark, folder, multi_line):
    path = folder(
        a="order_id,product_id,price,freight_value\n1,2,3,4\n",
        b="product_id,order_id,price,freight_value\n1,2,3,4\n",
    )
    with pytest.raises(Exception, match="header does not conform"):
        csv.read_raw_items(spark, path, multi_line).collect()


def test_raw_text_survives_a_round_trip(spark):
    cells = [" padded ", "", "NULL", 'a "q"', "a,b", "line\nbreak", "plain"]
    df = spark.createDataFrame(
        [(str(n), cell, "1", None) for n, cell in enumerate(cells)],
        "order_id string, product_id string, price string, freight_value string",
    )
    path = runs.new_path(spark, "raw")
    csv.write_raw_csv(df, path)
    raw = csv.read_raw_items(spark, path, multi_line=True)
    back = {r.order_id: r.product_id for r in raw.collect()}
    # An empty cell is one of the missing-value tokens, so NULL serves as well.
    assert [back[str(n)] or "" for n in range(len(cells))] == cells


def test_month_layout_prunes_and_keeps_every_row(spark):
    rows = [(str(n), "c", "created", datetime(2020, 1 + n % 12, 1 + n % 28, 23, 59), None)
            for n in range(400)]
    orders = cleaning.stamp_audit_columns(spark.createDataFrame(rows, CLEAN_ORDERS), DAY)
    path = runs.new_path(spark, "orders")
    parquet.write_orders_by_month(orders, path)
    back = parquet.read_orders_by_month(spark, path)
    assert back.schema.simpleString() == orders.schema.simpleString()
    assert set(back.collect()) == set(orders.collect())

    first, last = date(2020, 3, 5), date(2020, 4, 20)
    some = parquet.read_orders_by_month(spark, path, first, last)
    assert set(some.collect()) == {
        r for r in orders.collect() if first <= r.order_purchase_timestamp.date() <= last
    }
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "purchase_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = some.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("purchase_month=")[1][:6] for r in read} == {"202003", "202004"}


def test_jdbc_split_options():
    assert jdbc.key_range_options("id", 1, 1000, 4) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "1000",
        "numPartitions": "4",
    }
    assert jdbc.key_range_options("id", None, None, 4) == {}


class Recorder:
    """Stands for a reader or writer and notes what it is told: no database is started."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told |= options
        return self

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def load(self):
        return SimpleNamespace(first=lambda: {"lo": 1, "hi": 9})

    def save(self):
        self.told["saved"] = True


def test_jdbc_requests():
    read, write = Recorder(), Recorder()
    login = {"user": "u", "password": "p", "driver": "d"}
    session = SimpleNamespace(read=read)
    assert jdbc.key_bounds(session, "url", "shop.order_items", "id", login) == (1, 9)
    assert read.told["query"] == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM shop.order_items"

    read = Recorder()
    split = jdbc.key_range_options("id", 1, 9, 4)
    jdbc.read_jdbc(SimpleNamespace(read=read), "url", "shop.order_items", login, split)
    expected = {"format": "jdbc", "url": "url", "dbtable": "shop.order_items"}
    assert read.told == expected | login | split | {"fetchsize": "10000"}

    jdbc.write_jdbc(SimpleNamespace(write=write), "url", "staging", login)
    assert write.told == expected | login | {
        "dbtable": "staging",
        "truncate": "true",
        "batchsize": "10000",
        "numPartitions": "16",
        "mode": "overwrite",
        "saved": True,
    }


def test_run_log_follows_the_last_commit(spark):
    root = runs.new_path(spark, "curated")
    assert runs.current_run(spark, root) is None
    first = runs.commit_run(spark, root, None, DAY, "c1", {202401: "o1"}, "i1")
    second = runs.commit_run(spark, root, first, DAY, "c2", {202401: "o1", 202402: "o2"}, "i2")
    current = runs.current_run(spark, root)
    assert current == second and current.run_number == 2
    assert current.order_months == {202401: "o1", 202402: "o2"}
    assert runs.run_log(spark, root).count() == 2


def test_shared_folder_is_the_one_the_session_names(spark):
    assert runs.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def session_with(**settings):
    conf = SimpleNamespace(
        get=lambda name, default: settings.get(name.replace(".", "_"), default)
    )
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(applicationId="app-1"))


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runs.shared_folder(session_with(spark_master="yarn"))
    named = session_with(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared")
    assert runs.new_path(named, "x").startswith("hdfs:///shared/orderledger/x-")
    local = runs.shared_folder(session_with(spark_master="local[2]"))
    assert local == f"{tempfile.gettempdir()}/app-1"
