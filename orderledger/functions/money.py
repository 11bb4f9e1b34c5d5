from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MONEY, WIDE_MONEY

# What is wrong with a price text. The first two drop the row, the last is for the gate.
UNPARSEABLE, NEGATIVE, OUT_OF_RANGE = MONEY_ISSUES = [
    "unparseable",
    "negative",
    "out_of_range",
]

# Fixed value: what counts as a number when the decimal cast found none.
NUMBER_TEXT = r"(?i)\A\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*\z"
# Fixed value: the largest curated amount.
LARGEST = "99999999.99"


def parse_money(text: Column) -> Column:
    """DECIMAL(18,2), rounded half up, or NULL where the text is no such number.

    Wider than the curated column, so that what does not fit is seen and not lost. The decimal
    cast refuses what a double cast would let through ('1d', '0x1p3', 'NaN', 'inf'). It takes
    non-ASCII digits, so those are ruled out first.
    """
    return F.when(F.octet_length(text) == F.length(text), text.try_cast(WIDE_MONEY))


def money_issue(text: Column, parsed: Column) -> Column:
    """What is wrong with the price, NULL where it is fine.

    ``parsed`` is ``parse_money(text)``. A negative text that rounds to 0.00
    ('-0.004') is still negative. Only texts the cast refused, and zeros, get as
    far as the costlier tests.
    """
    minus = text.rlike(r"\A\s*-")
    not_positive = (
        F.when(parsed < 0, NEGATIVE)
        .when(parsed == 0, F.when(minus & (text.try_cast("double") < 0), NEGATIVE))
        .when(text.rlike(NUMBER_TEXT), F.when(minus, NEGATIVE).otherwise(OUT_OF_RANGE))
        .otherwise(UNPARSEABLE)
    )
    return F.when(parsed > F.lit(LARGEST).cast(WIDE_MONEY), OUT_OF_RANGE).when(
        ~F.coalesce(parsed > 0, F.lit(False)), not_positive
    )


def range_issue(text: Column, parsed: Column) -> Column:
    """OUT_OF_RANGE for a number of either sign that the curated column cannot hold."""
    beyond = F.abs(parsed) > F.lit(LARGEST).cast(WIDE_MONEY)
    return F.when(beyond | (parsed.isNull() & text.rlike(NUMBER_TEXT)), OUT_OF_RANGE)


def narrow_money(value: Column, issue: Column, name: str) -> Column:
    """The curated amount; an amount beyond it fails the job instead of getting lost."""
    refused = F.raise_error(F.lit(f"{name} does not fit DECIMAL(10,2)"))
    return F.when(issue == OUT_OF_RANGE, refused).otherwise(value.cast(MONEY))


def mean_money(total: Column, count: Column) -> Column:
    """``total / count`` to the cent, half away from zero, as DOUBLE.

    A decimal quotient is rounded once to its own scale and again to the cent,
    which is wrong near a half cent once the count is large. Whole cents and an
    integer division round once.
    """
    cents = F.abs(total * 100).cast("decimal(36,0)")
    rounded = F.call_function("div", cents * 2 + count, count * 2)
    signed = F.when(total < 0, -rounded).otherwise(rounded)
    return F.when(count > 0, signed.cast("double") / 100)
