"""Edge-case cells, one by one."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderledger.functions import parse_timestamp
from orderledger.operators import cleaning
from orderledger.schema import CLEAN_ITEMS, CLEAN_ORDERS, NULL_TOKENS

PRICES = {
    "1.5": ("1.50", None),
    " 2.5 ": ("2.50", None),
    "+5": ("5.00", None),
    ".5": ("0.50", None),
    "5.": ("5.00", None),
    "1e3": ("1000.00", None),
    "1.5e+2": ("150.00", None),
    "\t5\n": ("5.00", None),
    "1.005": ("1.01", None),
    "0": ("0.00", None),
    "-0.0": ("0.00", None),
    "1e-400": ("0.00", None),
    "99999999.994": ("99999999.99", None),
    "abc": (None, "unparseable"),
    "": (None, "unparseable"),
    None: (None, "unparseable"),
    "1,000": (None, "unparseable"),
    "0x10": (None, "unparseable"),
    "0x1p3": (None, "unparseable"),
    "1_000": (None, "unparseable"),
    "1 2": (None, "unparseable"),
    "1d": (None, "unparseable"),
    "1f": (None, "unparseable"),
    "-1d": (None, "unparseable"),
    "--1": (None, "unparseable"),
    "e5": (None, "unparseable"),
    ".": (None, "unparseable"),
    "-": (None, "unparseable"),
    "１": (None, "unparseable"),
    "inf": (None, "out_of_range"),
    "+Infinity": (None, "out_of_range"),
    "123456789012": ("123456789012.00", "out_of_range"),
    "1e20": (None, "out_of_range"),
    "99999999.996": ("100000000.00", "out_of_range"),
    "-1": ("-1.00", "negative"),
    "-123456789012": ("-123456789012.00", "negative"),
    "-1.005": ("-1.01", "negative"),
    "-0.004": ("0.00", "negative"),
    " -0.0000001": ("0.00", "negative"),
    "\t-0.004\n": ("0.00", "negative"),
    "\t-inf": (None, "negative"),
    "-inf": (None, "negative"),
    "-1e20": (None, "negative"),
    **{token: (None, "unparseable") for token in NULL_TOKENS},
}

TIMES = {
    "2018-01-02 03:04:05": datetime(2018, 1, 2, 3, 4, 5),
    "2018-1-2 3:04:05": datetime(2018, 1, 2, 3, 4, 5),
    # Falls into a daylight-saving gap of several zones.
    "2018-03-25 02:30:00": datetime(2018, 3, 25, 2, 30),
    "2018-01-02 \t 03:04:05": datetime(2018, 1, 2, 3, 4, 5),
    "2018-12-31  23:59:60": datetime(2019, 1, 1),
    "2018-01-02 03:04:61": datetime(2018, 1, 2, 3, 5, 1),
    "2018-01-02 03:04:62": None,
    "2018-01-02 03:60:00": None,
    "2018-01-02 03:60:60": None,
    "2262-04-11 23:47:16": datetime(2262, 4, 11, 23, 47, 16),
    "1677-09-21 00:12:44": datetime(1677, 9, 21, 0, 12, 44),
    "2262-04-11 23:47:17": None,
    "1677-09-21 00:12:43": None,
    "9999-12-31 00:00:00": None,
    "2018-01-02": None,
    "2018": None,
    "2018-01-02T03:04:05": None,
    "2018-01-02 03:04:05.123": None,
    " 2018-01-02 03:04:05 ": None,
    "2018-01-02 03:04:05\n": None,
    "01/02/2018": None,
    "2018-02-30 00:00:00": None,
    "2018-13-01 00:00:00": None,
    "bad": None,
    "": None,
    "2018-01-02 24:00:00": None,
    "2018-01-02 03:04": None,
    None: None,
    **{token: None for token in NULL_TOKENS},
}


def items(spark, rows):
    return spark.createDataFrame(
        rows, "order_id string, product_id string, price string, freight_value string"
    )


def orders(spark, rows):
    return spark.createDataFrame(
        rows,
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_delivered_customer_date string",
    )


def test_price_verdicts(spark):
    raw = items(spark, [("o", str(n), text, "1") for n, text in enumerate(PRICES)])
    got = {
        int(r.product_id): (r.price, r.price_issue)
        for r in cleaning.coerce_items(raw).collect()
    }
    for n, (text, (price, issue)) in enumerate(PRICES.items()):
        assert got[n] == (price and Decimal(price), issue), repr(text)


def test_clean_items_keeps_what_is_fine_and_flags_what_does_not_fit(spark):
    raw = items(spark, [("o", str(n), text, "1") for n, text in enumerate(PRICES)])
    clean = cleaning.clean_items(raw)
    issues = {int(r.product_id): r.price_issue for r in clean.collect()}
    assert issues == {
        n: issue
        for n, (_, issue) in enumerate(PRICES.values())
        if issue in (None, "out_of_range")
    }
    narrow = cleaning.narrow_items(clean.filter("price_issue IS NULL"))
    assert narrow.schema.simpleString() == CLEAN_ITEMS.simpleString()
    kept = {int(r.product_id) for r in narrow.collect()}
    assert kept == {n for n, issue in issues.items() if issue is None}
    with pytest.raises(Exception, match="price does not fit"):
        cleaning.narrow_items(clean).collect()
    counts = {
        r.outcome: r.item_count
        for r in cleaning.dropped_item_counts(cleaning.coerce_items(raw)).collect()
    }
    assert counts["kept"] == len(kept) and sum(counts.values()) == len(PRICES)
    for issue in ["unparseable", "out_of_range", "negative"]:
        assert counts[issue] == sum(i == issue for _, i in PRICES.values())


def test_bad_freight_is_kept_as_missing(spark):
    raw = items(spark, [("o", "a", "1", "n/a"), ("o", "b", "1", "-2"), ("o", "c", "1", None)])
    clean = cleaning.narrow_items(cleaning.clean_items(raw))
    got = {r.product_id: r.freight_value for r in clean.collect()}
    assert got == {"a": None, "b": Decimal("-2.00"), "c": None}
    filled = cleaning.default_freight(clean)
    assert {r.product_id: r.freight_value for r in filled.collect()} == {
        "a": Decimal("0.00"),
        "b": Decimal("-2.00"),
        "c": Decimal("0.00"),
    }


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/Sao_Paulo"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in TIMES], "t string")
        rows = df.select("t", parse_timestamp(F.col("t")).alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {r.t: r.p for r in rows} == TIMES


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_another_timestamp_form_by_pattern(spark, zone):
    texts = {
        "01/02/2018 03:04:05": datetime(2018, 1, 2, 3, 4, 5),
        # Falls into a daylight-saving gap.
        "03/25/2018 02:30:00": datetime(2018, 3, 25, 2, 30),
        "2018-01-02 03:04:05": None,
        "02/30/2018 00:00:00": None,
        "01/02/9999 00:00:00": None,
        '"01/02/2018, 03:04:05': None,
        "": None,
        None: None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        rows = df.select("t", parse_timestamp(F.col("t"), "MM/dd/yyyy H:m:s").alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {r.t: r.p for r in rows} == texts


def test_freight_out_of_range_is_flagged(spark):
    texts = {"1": None, "bad": None, "inf": 1, "-inf": 1, "123456789012": 1, "-1e30": 1, "-2": None}
    raw = items(spark, [("o", text, "1", text) for text in texts])
    got = {r.product_id: r.freight_issue for r in cleaning.coerce_items(raw).collect()}
    assert got == {text: bad and "out_of_range" for text, bad in texts.items()}


def test_delivery_date_is_filled_after_parsing(spark):
    good, other = "2018-01-02 03:04:05", "2018-02-03 04:05:06"
    raw = orders(
        spark,
        [
            ("007", "c", "created", good, other),
            ("b", "c", "created", good, None),
            ("c", "c", "created", good, "bad"),
            ("d", "c", "created", "bad", "bad"),
            ("e", "c", "created", "bad", other),
            ("f", "c", "created", good, "9999-12-31 00:00:00"),
        ],
    )
    clean = cleaning.clean_orders(raw)
    assert clean.schema.simpleString() == CLEAN_ORDERS.simpleString()
    first, second = datetime(2018, 1, 2, 3, 4, 5), datetime(2018, 2, 3, 4, 5, 6)
    got = {
        r.order_id: (r.order_purchase_timestamp, r.order_delivered_customer_date)
        for r in clean.collect()
    }
    assert got == {
        "007": (first, second),
        "b": (first, first),
        "c": (first, first),
        "d": (None, None),
        "e": (None, second),
        "f": (first, first),
    }


def test_null_tokens_are_exact(spark):
    kept = [" NA ", " ", "na", "none", "NAN", "x"]
    df = spark.createDataFrame([(t,) for t in NULL_TOKENS + kept], "t string")
    got = [r.t for r in cleaning.normalize_null_tokens(df).collect()]
    assert got == [None] * len(NULL_TOKENS) + kept


def test_optional_timestamp_columns_may_be_absent(spark):
    raw = orders(spark, [("a", "c", "created", "2018-01-02 03:04:05", "bad")])
    parsed = cleaning.parse_order_timestamps(raw.withColumn("order_approved_at", F.lit("bad")))
    assert parsed.first().order_approved_at is None
    assert dict(parsed.dtypes)["order_approved_at"] == "timestamp_ntz"
    assert "order_delivered_carrier_date" not in parsed.columns


def test_surrogate_ids_are_unique(spark):
    numbered = cleaning.surrogate_item_id(spark.range(1000).toDF("n").repartition(7))
    assert numbered.select("id").distinct().count() == 1000


def test_cleaning_its_own_output_changes_nothing(spark):
    from __spark_entry__ import items_of, orders_of

    sf_dir = "/root/testdata/sf0.001"
    for once, clean in [
        (orders_of(spark, sf_dir), cleaning.clean_orders),
        (items_of(spark, sf_dir), lambda raw: cleaning.narrow_items(cleaning.clean_items(raw))),
    ]:
        text = once.select([F.col(name).cast("string") for name in once.columns])
        again = clean(text)
        assert again.exceptAll(once).isEmpty() and once.exceptAll(again).isEmpty()


def test_every_row_is_kept_or_dropped_for_one_reason(spark):
    from proxy_inputs import varied_prices

    raw = varied_prices(spark, "/root/testdata/sf0.001")
    counts = cleaning.dropped_item_counts(cleaning.coerce_items(raw))
    counted = {r.outcome: r.item_count for r in counts.collect()}
    assert sum(counted.values()) == raw.count()
    assert counted["kept"] + counted["out_of_range"] == cleaning.clean_items(raw).count()
