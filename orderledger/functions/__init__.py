"""Column expressions. All are built from Spark's own functions."""

from .money import (
    MONEY_ISSUES,
    OUT_OF_RANGE,
    mean_money,
    money_issue,
    narrow_money,
    parse_money,
    range_issue,
)
from .text import missing_if_token
from .times import parse_timestamp

__all__ = [
    "MONEY_ISSUES",
    "OUT_OF_RANGE",
    "mean_money",
    "missing_if_token",
    "money_issue",
    "narrow_money",
    "parse_money",
    "parse_timestamp",
    "range_issue",
]
