"""Type inference, quoted line breaks, heavy keys, dense ids, layouts, digests, increments, leases."""

import collections
import csv as python_csv
import io
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderledger.operators import frequent, inference, joins, numbering, snapshots
from orderledger.plans import etl, revenue
from orderledger.sources import csv, layout, quoted_csv, runs
from tests.test_scale import settings

DAY = datetime(2024, 1, 1)


# Inference


def types_of(spark, cells, percent=100):
    df = spark.createDataFrame([(cell,) for cell in cells], "cell string")
    row = inference.infer_column_types(df, percent).first()
    return row.inferred_type, row.pattern, row.fitting_count


@pytest.mark.parametrize(
    "cells, kind, pattern",
    [
        (["NA", "", None], "void", None),
        (["true", "False", "n/a"], "boolean", None),
        (["1", " -20 ", "007"], "bigint", None),
        (["1", "9" * 19], "decimal(19,0)", None),
        (["1", "2.50", ".125"], "decimal(4,3)", None),
        (["1" * 30 + ".5", "0." + "1" * 9], "double", None),
        (["1", "2e5", "inf"], "double", None),
        (["2020-01-02 03:04:05", "NULL"], "timestamp_ntz", "yyyy-MM-dd HH:mm:ss"),
        (["2020-01-02", "2020-02-29"], "timestamp_ntz", "yyyy-MM-dd"),
        (["2020-01-02", "2020-02-30"], "string", None),
        (["01/13/2020 00:00:00", "02/03/2020 00:00:00"], "timestamp_ntz", "MM/dd/yyyy HH:mm:ss"),
        (["13/01/2020 00:00:00", "02/03/2020 00:00:00"], "timestamp_ntz", "dd/MM/yyyy HH:mm:ss"),
        (["13/01/2020 00:00:00", "01/13/2020 00:00:00"], "string", None),
        (["1", "x"], "string", None),
    ],
)
def test_types_of_columns(spark, cells, kind, pattern):
    assert types_of(spark, cells)[:2] == (kind, pattern)


def test_enough_cells_decide_and_the_others_become_null(spark):
    cells = ["1.5"] * 9 + ["abc", None]
    assert types_of(spark, cells) == ("string", None, 10)
    assert types_of(spark, cells, 90) == ("decimal(2,1)", None, 9)
    df = spark.createDataFrame([(c, "x") for c in cells], "cell string, other string")
    typed = inference.cast_columns(df, inference.infer_column_types(df, 90).collect())
    assert dict(typed.dtypes) == {"cell": "decimal(2,1)", "other": "string"}
    assert sum(r.cell is None for r in typed.collect()) == 2
    assert types_of(spark, []) == ("void", None, 0)


def test_inference_is_one_pass(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    plan = inference.infer_column_types(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan


def test_a_cell_is_tried_by_few_expressions(spark):
    df = spark.createDataFrame([("1",) * 5], "a string, b string, c string, d string, e string")
    with settings(spark, spark__sql__adaptive__enabled="false"):
        found = inference.infer_column_types(df)._jdf.queryExecution()
        plan, physical = found.optimizedPlan().toString(), found.executedPlan()
    assert "regexp_replace" not in plan and "regexp_extract" not in plan
    stats = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$")
    stages = getattr(stats, "MODULE$").codegenStringSeq(physical)
    sizes = [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())]
    assert sizes and max(sizes) < 8000  # larger methods stay interpreted


@pytest.mark.parametrize(
    "cells, kind, fitting",
    [
        (["    -1e-55", "    -1"], "double", 2),
        (["+000123.450", "\t.5 "], "decimal(6,3)", 2),
        (["2020-01-02 03:04:5 "], "string", 1),
        (["2020-01-02\n"], "string", 1),
        (["truſe"], "string", 1),
        (["02/03/2020 00:00:00", "12/12/2021 10:00:00"], "timestamp_ntz", 2),
    ],
)
def test_kinds_of_odd_cells(spark, cells, kind, fitting):
    assert types_of(spark, cells)[::2] == (kind, fitting)


# Quoted line breaks


def random_cell(rng):
    return "".join(rng.choice('ab",\n \r') for _ in range(rng.randrange(9)))


def written_rows(path, names, rows, ending="\n"):
    out = io.StringIO()
    writer = python_csv.writer(out, lineterminator=ending, quoting=python_csv.QUOTE_ALL)
    writer.writerows([names, *rows])
    path.write_bytes(out.getvalue().encode())


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_quoted_rows_are_those_of_one_task_for_each_file(spark, tmp_path, monkeypatch, ending):
    monkeypatch.setattr(quoted_csv, "PIECE", 7)
    rng = random.Random(5)
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(2):
        rows = [[f"{k}-{n}", random_cell(rng), random_cell(rng)] for n in range(400)]
        written_rows(folder / f"{k}.csv", ["id", "b", "c"], rows, ending)
    with settings(spark, spark__sql__files__maxPartitionBytes="2KB"):
        text = spark.read.text(str(folder / "0.csv"))
        assert text.select(F.spark_partition_id()).distinct().count() > 4
        found = quoted_csv.read_csv_quoted(spark, str(folder), ["id"])
        got = collections.Counter(map(tuple, found.collect()))
    expected = collections.Counter(
        map(tuple, csv.read_csv(spark, str(folder), ["id"], multi_line=True).collect())
    )
    assert got == expected, (list((got - expected))[:3], list((expected - got))[:3])
    assert sum(got.values()) == 800


def test_text_is_read_once(spark, tmp_path):
    written_rows(tmp_path / "a.csv", ["id", "b"], [[str(n), "x\ny"] for n in range(50)])
    df = quoted_csv.read_csv_quoted(spark, str(tmp_path / "a.csv"), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and plan.count("FileScan parquet") >= 2
    sums = [line for line in plan.splitlines() if "FileScan parquet" in line and "value" not in line]
    assert sums  # the pieces' sums leave the text alone


def test_what_quoted_reading_refuses(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('id,b\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="no partner"):
        quoted_csv.read_csv_quoted(spark, str(tmp_path / "odd.csv"), ["id"]).collect()
    (tmp_path / "long.csv").write_text('id,b\n1,2,"3\n4"\n')
    with pytest.raises(Exception, match="too many cells"):
        quoted_csv.read_csv_quoted(spark, str(tmp_path / "long.csv"), ["id"]).collect()
    with pytest.raises(ValueError, match="lacks the columns"):
        quoted_csv.read_csv_quoted(spark, str(tmp_path / "long.csv"), ["absent"])
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("id,b\n1,2\n")
    (folder / "b.csv").write_text("b,id\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        quoted_csv.read_csv_quoted(spark, str(folder), ["id"]).collect()
    (tmp_path / "short.csv").write_text("id,b\n1\n\n2,3\n")
    short = quoted_csv.read_csv_quoted(spark, str(tmp_path / "short.csv"), ["id"])
    assert sorted(map(tuple, short.collect())) == [("1", None), ("2", "3")]


# Heavy keys and joins


def test_heavy_keys_are_exact(spark):
    keys = ["hot"] * 9000 + [None] * 500
    keys += [f"warm {k}" for k in range(30) for _ in range(40 - k)]
    keys += [f"cold {k}" for k in range(20000)]
    df = spark.createDataFrame([(key,) for key in keys], "order_id string")
    total = sum(key is not None for key in keys)
    expected = {k: n for k, n in collections.Counter(keys).items() if k and n * 1000 > total}
    assert {r.order_id: r.n for r in frequent.heavy_keys(df).collect()} == expected
    copies = frequent.copies_of_heavy_keys(df, "order_id")
    assert copies == {k: -(-n * 1000 // total) for k, n in expected.items()}
    assert frequent.copies_of_heavy_keys(df.filter("order_id IS NULL"), "order_id") == {}


def test_equal_items_of_a_hot_order_go_to_many_tasks(spark):
    orders = spark.createDataFrame([("hot", DAY), ("o", DAY)], "order_id string, t timestamp_ntz")
    orders = orders.withColumnRenamed("t", "order_purchase_timestamp")
    items = spark.range(30000, numPartitions=8).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise("o").alias("order_id"),
        F.lit("p").alias("product_id"),
        F.lit(1).cast("decimal(10,2)").alias("price"),
        F.lit(None).cast("decimal(10,2)").alias("freight_value"),
    )
    path = runs.new_path(spark, "equal_items")
    items.write.parquet(path)
    off = {"spark__sql__autoBroadcastJoinThreshold": "-1",
           "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
           "spark__sql__adaptive__coalescePartitions__enabled": "false",
           "spark__sql__shuffle__partitions": "64"}
    with settings(spark, **off):
        joined = joins.join_orders_items(orders, spark.read.parquet(path))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "product_id" not in plan and "freight_value" not in plan
        tasks = joined.filter("order_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 27000 and len(tasks) > 32
    assert max(r["count"] for r in tasks) < 2700


# Ids


@pytest.mark.parametrize("order", [None, ["key", "value"]])
def test_ids_are_dense_and_go_on(spark, order):
    rows = [(k % 3, "hot" if k % 2 else f"v{k % 50}") for k in range(500)]
    df = spark.createDataFrame(rows, "key int, value string").repartition(7)
    path = runs.new_path(spark, "ids")
    found = numbering.dense_ids(df, path, 100, order).collect()
    assert sorted(r.id for r in found) == list(range(101, 601))
    assert collections.Counter((r.key, r.value) for r in found) == collections.Counter(rows)
    if order:
        by_id = [(r.key, r.value) for r in sorted(found, key=lambda r: r.id)]
        assert by_id == sorted(rows)  # however the rows were dealt
    empty = numbering.dense_ids(df.filter("key > 5"), runs.new_path(spark, "ids"), 7, order)
    assert empty.collect() == []


# Layouts


def test_lookups_open_few_files(spark):
    df = spark.range(40000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 997).cast("string")).alias("a"),
        F.when(F.col("id") % 101 > 0, (F.col("id") % 613).cast("string")).alias("b"),
        "id",
    )
    path = runs.new_path(spark, "layout")
    layout.write_interleaved(df, path, ["a", "b"], 64)
    files = spark.read.parquet(f"{path}/manifest")
    assert 60 <= files.count() <= 64 and files.agg(F.sum("rows")).first()[0] == 40000
    for column, value in [("a", "5"), ("b", "7"), ("a", "hot"), ("b", None), ("a", "absent")]:
        rows = layout.rows_with(spark, path, column, value).collect()
        plain = df.filter(F.col(column).eqNullSafe(F.lit(value))).collect()
        assert sorted(r.id for r in rows) == sorted(r.id for r in plain)
        if value != "hot":
            assert len(layout.files_with(spark, path, column, value)) <= 20


# Digests


def test_digests_tell_cells_and_repeats(spark):
    rows = [("a", None, 1), (None, "a", 1), ("b", "c", 2), ("b", "c", 2)]
    schema = "x string, y string, n int"

    def of(rows):
        return snapshots.checksum(spark.createDataFrame(rows, schema))

    assert of(rows) == of(rows[::-1]) == snapshots.checksum(
        spark.createDataFrame(rows, schema).repartition(5).select("n", "y", "x")
    )
    for other in ([*rows[:3], ("b", "c", 3)], rows[:3], [*rows, rows[0]],
                  [(None, "a", 1), (None, "a", 1), *rows[2:]], [(None, None, 1), ("a", "a", 1), *rows[2:]]):
        assert of(other) != of(rows)
    path = runs.new_path(spark, "digest")
    written = snapshots.write_checked(spark.createDataFrame(rows, schema), path)
    snapshots.verify(spark, path, written)
    spark.createDataFrame(rows[:1], schema).write.mode("append").parquet(path)
    with pytest.raises(snapshots.SnapshotMismatch):
        snapshots.verify(spark, path, written)


def test_changed_rows_count_copies(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b"]), rng.randrange(4)) for _ in range(300)]
    later = rows[:250] + [("new", 1), ("new", 1), (None, None)]
    before, after = (spark.createDataFrame(x, "k string, n int") for x in (rows, later))
    found = {(r.change, r.k, r.n): r.copies for r in snapshots.changed_rows(before, after).collect()}
    old, new = collections.Counter(rows), collections.Counter(later)
    expected = {("added", *k): n for k, n in (new - old).items()}
    expected |= {("removed", *k): n for k, n in (old - new).items()}
    assert found == expected
    assert snapshots.changed_rows(before, before.repartition(3)).collect() == []


# Loads


ORDERS = "order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date"
ITEMS = "order_id,product_id,price,freight_value"


@pytest.fixture
def load(spark, tmp_path):
    root = str(tmp_path / "curated")

    def run(order_rows, item_rows, when):
        (tmp_path / "orders.csv").write_text("\n".join([ORDERS, *order_rows]) + "\n")
        (tmp_path / "items.csv").write_text("\n".join([ITEMS, *item_rows]) + "\n")
        spark.catalog.clearCache()
        etl.run_etl(spark, f"{tmp_path}/orders.csv", f"{tmp_path}/items.csv", root, when)
        return runs.current_run(spark, root)

    run.root = root
    return run


FIRST = ["a,c,created,2020-01-01 10:00:00,", "b,c,shipped,2020-02-01 10:00:00,",
         "d,c,shipped,2020-03-01 10:00:00,", "e,c,canceled,2020-03-01 10:00:00,"]
ITEM_ROWS = ["a,p,1.50,0.10", "b,p,2,0", "b,q,2,0", "d,q,5,0", "e,q,7,0"]


def by_day(df):
    return {r.report_date: (r.order_count, r.daily_revenue, r.avg_order_value) for r in df.collect()}


def test_state_of_a_load_that_touches_every_month_needs_no_digests(spark, load, monkeypatch):
    first = load(FIRST, ITEM_ROWS, DAY)
    orders, items = etl.read_current_orders(spark, first), etl.read_current_items(spark, first)
    state = revenue.daily_state(orders, items)
    assert "distinct" not in state._jdf.queryExecution().logical().toString()
    second = load([row.replace("canceled", "shipped") for row in FIRST],
                  [*ITEM_ROWS[:-1], "e,q,8,0"], datetime(2024, 2, 1))
    monkeypatch.setattr(snapshots, "checksum", None)
    found = by_day(revenue.view_of(revenue.refreshed_state(spark, state, first, second)))
    assert {str(day): values for day, values in found.items()} == {
        "2020-01-01": (1, 1.5, 1.5), "2020-02-01": (1, 4.0, 2.0), "2020-03-01": (2, 13.0, 6.5)
    }


def test_state_follows_loads_and_reads_touched_months(spark, load):
    first = load(FIRST, ITEM_ROWS, DAY)
    state = spark.createDataFrame(
        revenue.daily_state(
            etl.read_current_orders(spark, first), etl.read_current_items(spark, first)
        ).collect(),
        "report_date date, amount decimal(28,2), priced bigint, order_count bigint",
    )
    # The February order is canceled, its items and all others stay.
    second = load(["b,c,canceled,2020-02-01 10:00:00,"], ITEM_ROWS, datetime(2024, 2, 1))
    old, new = revenue.touched_months(first, second)
    assert len(old) == len(new) == 1 and "202002" in old[0]
    state = revenue.refreshed_state(spark, state, first, second)

    def whole(run):
        return revenue.view_of(
            revenue.daily_state(etl.read_current_orders(spark, run), etl.read_current_items(spark, run))
        )

    assert by_day(revenue.view_of(state)) == by_day(whole(second)) and len(by_day(whole(second))) == 2
    # An order comes alive, another moves to another month, and a price changes where no order did.
    third = load(["e,c,shipped,2020-03-01 10:00:00,", "a,c,created,2020-05-01 10:00:00,"],
                 [*ITEM_ROWS[:3], "d,q,6,0", "e,q,7,0"], datetime(2024, 3, 1))
    state = revenue.refreshed_state(spark, state, second, third)
    assert by_day(revenue.view_of(state)) == by_day(whole(third))


def test_item_ids_go_on_from_load_to_load(spark, load):
    ids = []
    for k in range(2):
        run = load(FIRST, ITEM_ROWS, datetime(2024, 1, 1 + k))
        ids.append(sorted(r.id for r in etl.read_current_items(spark, run).collect()))
    assert ids == [[1, 2, 3, 4, 5], [6, 7, 8, 9, 10]] and run.last_item_id == 10


def test_a_claim_left_behind_is_taken_over_after_its_lease(spark, load):
    first = load(FIRST, ITEM_ROWS, DAY)
    assert runs.claim(spark, load.root, 2) == 0  # a load that died right after this
    with pytest.raises(runs.RunConflict):
        load(FIRST, ITEM_ROWS, datetime(2024, 1, 2))
    record = (first, DAY, first.orders_clean_path, first.order_months, first.items_path, 5)
    run = runs.commit_run(spark, load.root, *record, lease=0)
    assert (run.run_number, run.attempt) == (2, 1)
    # What had been claimed first finishes late: its record does not count.
    assert runs._claimed_later(spark, load.root, 2, 0)
    assert runs.current_run(spark, load.root).attempt == 1
    with pytest.raises(runs.RunConflict):
        runs.claim(spark, load.root, 2, lease=0)  # there is a record now


def test_sweep_leaves_what_a_record_names(spark, load, tmp_path):
    first = load(FIRST, ITEM_ROWS, DAY)
    second = load(["b,c,delivered,2020-02-01 10:00:00,"], ITEM_ROWS, datetime(2024, 1, 2))
    dead = f"{load.root}/runs/dead"
    spark.range(1).write.parquet(f"{dead}/orders")
    assert runs.sweep(spark, load.root) == []  # too young
    assert runs.sweep(spark, load.root, age=0) == ["dead"]
    before = by_day(revenue.view_of(revenue.daily_state(
        etl.read_current_orders(spark, second), etl.read_current_items(spark, second))))
    assert len(before) == 3 and first.items_path != second.items_path
    third = load(FIRST, ITEM_ROWS, datetime(2024, 1, 3))
    gone = runs.sweep(spark, load.root, age=0)
    assert len(gone) == 2 and runs.reachable_folders(spark, load.root)
    assert etl.read_current_orders(spark, third).count() == 4
