"""The whole load, twice and with failures."""

import pathlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderledger.operators import reports
from orderledger.operators.quality import DataQualityError
from orderledger.plans import daily_report, etl
from orderledger.sources import csv, parquet, runs

FIRST, SECOND = datetime(2024, 1, 1), datetime(2025, 1, 1)
ORDERS = "order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date"
ITEMS = "order_id,product_id,price,freight_value"


@pytest.fixture
def load(spark, tmp_path):
    root = str(tmp_path / "curated")

    def run(order_rows, item_rows, run_ts):
        (tmp_path / "orders.csv").write_text("\n".join([ORDERS, *order_rows]) + "\n")
        (tmp_path / "items.csv").write_text("\n".join([ITEMS, *item_rows]) + "\n")
        spark.catalog.clearCache()
        return etl.run_etl(
            spark, str(tmp_path / "orders.csv"), str(tmp_path / "items.csv"), root, run_ts
        )

    run.root = root
    return run


GOOD_ORDERS = ["a,c,created,2020-01-01 10:00:00,", "b,c,shipped,2020-02-01 10:00:00,bad"]
GOOD_ITEMS = ["a,p,1.50,0.10", "a,p,bad,0.10", "b,p,-2,0.10", "b,q,2,NA", "b,q,-inf,1"]


def test_two_loads(spark, load):
    result = load(GOOD_ORDERS, GOOD_ITEMS, FIRST)
    assert (result.order_rows, result.item_rows) == (2, 2)
    assert result.dropped_items == {"unparseable": 1, "negative": 2}
    assert [r.rule for r in result.checks if r.violations] == ["freight_value_missing"]

    later = ["b,c,delivered,2020-02-01 10:00:00,2020-02-05 10:00:00",
             "n,c,created,2020-03-01 10:00:00,"]
    load(later, ["n,p,3,0"], SECOND)
    run = runs.current_run(spark, load.root)
    orders = etl.read_current_orders(spark, run)
    assert {(r.order_id, r.order_status, r.created_at, r.updated_at) for r in orders.collect()} == {
        ("a", "created", FIRST, FIRST),
        ("b", "delivered", FIRST, SECOND),
        ("n", "created", SECOND, SECOND),
    }
    items = parquet.read_parquet(spark, run.items_path)
    assert [r.order_id for r in items.collect()] == ["n"]
    clean = parquet.read_parquet(spark, run.orders_clean_path)
    assert {r.order_id for r in clean.collect()} == {"b", "n"}


def test_another_timestamp_form(spark, tmp_path):
    row = "a,c,created,01/02/2020 10:00:00,01/05/2020 2:30:00"
    (tmp_path / "orders.csv").write_text(f"{ORDERS}\n{row}\n")
    (tmp_path / "items.csv").write_text(f"{ITEMS}\n")
    run = etl.run_etl(
        spark,
        str(tmp_path / "orders.csv"),
        str(tmp_path / "items.csv"),
        str(tmp_path / "curated"),
        FIRST,
        pattern="MM/dd/yyyy H:m:s",
    ).run
    row = etl.read_current_orders(spark, run).first()
    assert row.order_delivered_customer_date == datetime(2020, 1, 5, 2, 30)


def test_an_empty_item_batch_gives_an_empty_table(spark, load):
    load(GOOD_ORDERS, GOOD_ITEMS, FIRST)
    result = load(GOOD_ORDERS, [], SECOND)
    assert result.item_rows == 0
    assert parquet.read_parquet(spark, result.run.items_path).count() == 0


@pytest.mark.parametrize(
    "order_rows, item_rows, rule",
    [
        (GOOD_ORDERS + GOOD_ORDERS[:1], GOOD_ITEMS, "order_id_unique"),
        (["NULL,c,created,2020-01-01 10:00:00,"], [], "order_id_not_null"),
        (["a,c,lost,2020-01-01 10:00:00,"], [], "order_status_in_domain"),
        (["a,c,created,2020-01-01,"], [], "order_purchase_timestamp_not_null"),
        (["a,c,created,bad,bad"], [], "order_purchase_timestamp_not_null"),
        (GOOD_ORDERS, ["z,p,1,1"], "order_id_known"),
        (GOOD_ORDERS, ["a,p,1,-1"], "freight_value_negative"),
        (GOOD_ORDERS, ["a,NA,1,1"], "product_id_not_null"),
        (GOOD_ORDERS, ["a,p,123456789012.00,1"], "price_range"),
        (GOOD_ORDERS, ["a,p,inf,1"], "price_range"),
        (GOOD_ORDERS, ["a,p,1,123456789012"], "freight_value_range"),
        (GOOD_ORDERS, ["a,p,1,-inf"], "freight_value_range"),
    ],
)
def test_a_refused_batch_changes_nothing(spark, load, order_rows, item_rows, rule):
    before = load(GOOD_ORDERS, GOOD_ITEMS, FIRST).run
    with pytest.raises(DataQualityError, match=rule):
        load(order_rows, item_rows, SECOND)
    after = runs.current_run(spark, load.root)
    assert after.run_number == 1 and after.order_months == before.order_months
    assert after.items_path == before.items_path
    assert etl.read_current_orders(spark, after).filter(F.col("updated_at") > FIRST).count() == 0


def test_report_on_current_tables(spark, load):
    run = load(GOOD_ORDERS, GOOD_ITEMS, FIRST).run
    orders = parquet.read_parquet(spark, run.orders_clean_path)
    items = parquet.read_parquet(spark, run.items_path)
    path = runs.new_path(spark, "report")
    assert daily_report.write_daily_report(orders, items, path) == 2
    daily_report.verify_daily_report(spark, path, 2, orders, items)
    assert [tuple(r)[1:] for r in csv.read_report(spark, path).collect()] == [(1.5, 1), (2.0, 1)]


def test_jobs(spark, tmp_path, capsys):
    import jobs

    (tmp_path / "orders.csv").write_text("\n".join([ORDERS, *GOOD_ORDERS]) + "\n")
    (tmp_path / "items.csv").write_text("\n".join([ITEMS, *GOOD_ITEMS]) + "\n")
    root, out = str(tmp_path / "curated"), str(tmp_path / "report")
    args = jobs.parse(["report", "--root", root, "--out", out])
    with pytest.raises(SystemExit, match="no load"):
        args.run(spark, args)
    for command in [
        ["load", "--orders", str(tmp_path / "orders.csv"), "--items", str(tmp_path / "items.csv"),
         "--root", root, "--multi-line"],
        ["report", "--root", root, "--out", out],
    ]:
        args = jobs.parse(command)
        args.run(spark, args)
    assert "loaded 2 items, dropped" in capsys.readouterr().out
    assert csv.read_report(spark, out).count() == 2


def files_of(folder):
    return {path: path.stat().st_mtime_ns for path in pathlib.Path(folder).rglob("*.parquet")}


def test_only_touched_months_are_rewritten(spark, load):
    first = load(
        [f"o{n},c,created,2020-{n:02}-01 10:00:00," for n in range(1, 7)], ["o1,p,1,0"], FIRST
    ).run
    before = {month: files_of(folder) for month, folder in first.order_months.items()}
    assert sorted(before) == [202001 + n for n in range(6)]
    # One order stays in its month, one moves to another, one is new in a month of its own.
    batch = ["o1,c,shipped,2020-01-01 10:00:00,", "o2,c,shipped,2020-03-09 10:00:00,",
             "n,c,created,2021-01-01 10:00:00,"]
    second = load(batch, ["o1,p,1,0"], SECOND).run
    changed = {m for m, f in second.order_months.items() if first.order_months.get(m) != f}
    assert changed == {202001, 202003, 202101}
    assert 202002 not in second.order_months  # its only order has moved
    for month in (202004, 202005, 202006):
        assert files_of(second.order_months[month]) == before[month]
    orders = etl.read_current_orders(spark, second).collect()
    assert sorted(r.order_id for r in orders) == ["n", "o1", "o2", "o3", "o4", "o5", "o6"]
    assert {r.order_id for r in orders if r.updated_at == SECOND} == {"n", "o1", "o2"}
    third = load(batch, ["o1,p,1,0"], SECOND).run
    again = etl.read_current_orders(spark, third).collect()
    assert set(again) == set(orders) and len(again) == len(orders)


def test_two_loads_from_one_record_cannot_both_finish(spark, load):
    before = load(GOOD_ORDERS, GOOD_ITEMS, FIRST).run
    runs.commit_run(spark, load.root, before, SECOND, "c", {202001: "o"}, "i")
    with pytest.raises(runs.RunConflict, match="run 2"):
        runs.commit_run(spark, load.root, before, SECOND, "c", {202001: "p"}, "i")
    assert runs.current_run(spark, load.root).order_months == {202001: "o"}


def test_a_defect_in_the_daily_sums_is_noticed(spark, load, monkeypatch):
    run = load(GOOD_ORDERS, GOOD_ITEMS, FIRST).run
    orders = parquet.read_parquet(spark, run.orders_clean_path)
    items = etl.read_current_items(spark, run)
    right = reports._per_day
    for broken in (
        lambda o, i: right(o, i.filter("order_id <> 'a'")),
        lambda o, i: right(o, i).withColumn("amount", F.col("amount") + F.lit(1)),
        lambda o, i: right(o, i).withColumn("order_count", F.col("order_count") * 2),
    ):
        monkeypatch.setattr(reports, "_per_day", broken)
        path = runs.new_path(spark, "report")
        days = daily_report.write_daily_report(orders, items, path)
        with pytest.raises(daily_report.ReportMismatch):
            daily_report.verify_daily_report(spark, path, days, orders, items)
    path = runs.new_path(spark, "report")
    monkeypatch.setattr(reports, "_per_day", right)
    days = daily_report.write_daily_report(orders, items, path)
    with pytest.raises(daily_report.ReportMismatch, match="report_days"):
        daily_report.verify_daily_report(spark, path, days + 1, orders, items)


def test_view_by_name_reads_the_merged_tables(spark, load):
    load(GOOD_ORDERS, GOOD_ITEMS, FIRST)
    daily_report.create_revenue_view(spark, load.root, "revenue")
    assert {r.daily_revenue for r in spark.table("revenue").collect()} == {1.5, 2.0}
    load(["b,c,canceled,2020-02-01 10:00:00,"], GOOD_ITEMS, SECOND)
    daily_report.create_revenue_view(spark, load.root, "revenue")
    assert [r.daily_revenue for r in spark.table("revenue").collect()] == [1.5]
    with pytest.raises(ValueError, match="no load"):
        daily_report.create_revenue_view(spark, runs.new_path(spark, "none"))
