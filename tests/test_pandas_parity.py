"""Random cell texts: kept, dropped and valued as pandas does it."""

import csv as csv_module
import random
import re
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderledger.functions import parse_timestamp
from orderledger.operators import cleaning
from orderledger.schema import NULL_TOKENS
from orderledger.sources import csv

TEXTS = 8000


def random_number(rng):
    if rng.random() < 0.4:
        letters = "0123456789+-.eE_, dfxinaINF\t\n"
        return "".join(rng.choice(letters) for _ in range(rng.randrange(8)))
    body = rng.choice(
        [
            str(rng.randrange(10 ** rng.randint(1, 12))),
            f"{rng.random() * 10 ** rng.randint(-8, 10):.{rng.randint(0, 9)}f}",
            f"{rng.random():.3e}",
            f".{rng.randrange(1000)}",
            f"{rng.randrange(100)}.",
            f"00{rng.randrange(100)}",
            f"1e{rng.randint(-320, 300)}",
            "nan",
        ]
    )
    before = rng.choice(["", "", "+", "-", " ", "+ ", " -", "--"])
    after = rng.choice(["", "", " ", "\n", "d", "f", "L", "%", "e", "e5", "E-3", "e+2", "\xa0"])
    return before + body + after


def random_time(rng):
    def two(low, high):
        return rng.choice(["{:02d}", "{}"]).format(rng.randint(low, high))

    year = rng.choice([rng.randint(0, 9999), rng.randint(1600, 2300), rng.randint(1990, 2020)])
    dash = rng.choice("----/.")
    between = rng.choice([" ", " ", " ", "T", "  ", "\t", ""])
    day = f"{rng.choice(['{:04d}', '{}']).format(year)}{dash}{two(0, 14)}{dash}{two(0, 33)}"
    clock = f"{two(0, 25)}:{two(0, 62)}:{two(0, 62)}"
    before = rng.choice(["", "", "", "", " ", "+", "-"])
    return before + day + between + clock + rng.choice(["", "", "", "", " ", ".5", "Z", "+00:00"])


def distinct(make, first=()):
    rng = random.Random(20)
    return list(dict.fromkeys([*first, *(make(rng) for _ in range(TEXTS))]))


def test_prices(spark):
    texts = distinct(random_number)
    raw = spark.createDataFrame(
        [("o", str(n), text, "1") for n, text in enumerate(texts)],
        "order_id string, product_id string, price string, freight_value string",
    )
    got = {int(r.product_id): r for r in cleaning.coerce_items(raw).collect()}
    known = [None if text in NULL_TOKENS else text for text in texts]
    values = pd.to_numeric(pd.Series(known, dtype=object), errors="coerce")
    kept = 0
    for n, value in enumerate(values):
        row = got[n]
        if pd.isna(value):
            # A number beyond the range of a double is missing in pandas.
            huge = re.search(r"[eE][+-]?\d{3}", texts[n])
            assert row.price_issue == "unparseable" or (huge and row.price_issue), texts[n]
        elif row.price_issue == "out_of_range":  # kept by pandas; see README
            assert value > 99999999.99, texts[n]
        elif value < 0:
            assert row.price_issue == "negative", texts[n]
        else:
            assert row.price_issue is None, texts[n]
            assert abs(float(row.price) - value) < 0.00501, texts[n]
            kept += 1
    assert kept > 1000


def test_timestamps(spark):
    # The first text fixes the form that pandas expects of the rest.
    texts = distinct(random_time, first=["2018-01-02 03:04:05"])
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    got = {r.n: r.p for r in frame.select("n", parse_timestamp(F.col("t")).alias("p")).collect()}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        parsed = pd.to_datetime(pd.Series(texts, dtype=object), errors="coerce")
    expected = {n: None if pd.isna(p) else p.to_pydatetime() for n, p in enumerate(parsed)}
    assert got == expected
    assert sum(p is not None for p in got.values()) > 200


def random_cell(rng):
    if rng.random() < 0.3:
        return rng.choice(NULL_TOKENS + [" NA ", "na", "none", "NAN", " ", "N/A ", "-", "\\N"])
    return "".join(rng.choice('ab1",\'\\ \n;#é') for _ in range(rng.randrange(6)))


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_cells(spark, tmp_path, multi_line):
    rng = random.Random(20)
    rows = [[str(n), *(random_cell(rng) for _ in range(3))] for n in range(2000)]
    if not multi_line:
        rows = [[cell.replace("\n", " ") for cell in row] for row in rows]
    for row in rows[::7]:
        del row[rng.randint(2, 4) :]
    names = ["order_id", "product_id", "price", "freight_value"]
    with open(tmp_path / "items.csv", "w", newline="") as file:
        writer = csv_module.writer(file, lineterminator="\n")
        writer.writerows([names, *rows])
    path = str(tmp_path / "items.csv")
    raw = cleaning.normalize_null_tokens(csv.read_raw_items(spark, path, multi_line))
    got = {r.order_id: tuple(r) for r in raw.select(names).collect()}
    frame = pd.read_csv(path, dtype=str)
    expected = {
        row[0]: tuple(None if pd.isna(cell) else cell for cell in row)
        for row in frame.itertuples(index=False)
    }
    assert len(got) == len(rows)
    assert got == expected
