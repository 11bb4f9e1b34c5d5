from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one accepted timestamp form, and the range of a 64-bit
# nanosecond timestamp (9999-12-31 as "never" falls outside and is missing).
TIMESTAMP_TEXT = r"\A\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}\z"
EARLIEST = "1677-09-21 00:12:44"
LATEST = "2262-04-11 23:47:16"


def _cast(text: Column) -> Column:
    """Spark's cast, which takes one blank and no leap second, and then those two."""
    spaced = F.regexp_replace(text, r"\s+", " ")
    ten_less = F.regexp_replace(spaced, r"(:\d{1,2}):6([01])\z", "$1:5$2")
    leap = ten_less.try_cast("timestamp_ntz") + F.expr("INTERVAL '10' SECOND")
    return F.coalesce(
        text.try_cast("timestamp_ntz"), spaced.try_cast("timestamp_ntz"), leap
    )


def _by_pattern(text: Column, pattern: str) -> Column:
    """The text read by a datetime pattern as one CSV cell, which no quote or comma can end.

    A cell is read straight to TIMESTAMP_NTZ, as a pattern function would not do.
    """
    cell = {"timestampNTZFormat": pattern, "sep": "\u0001", "quote": "\u0002"}
    return F.when(text != "", F.from_csv(text, "value TIMESTAMP_NTZ", cell)["value"])


def parse_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Zone-free timestamp, or NULL where the text is bad.

    Without a datetime ``pattern`` the text is to have the form of TIMESTAMP_TEXT. Both ways
    go straight to TIMESTAMP_NTZ: ``try_to_timestamp`` reads in the session's zone and moves
    wall-clock times that fall into a daylight-saving gap.
    """
    parsed = _by_pattern(text, pattern) if pattern else _cast(text)
    in_range = parsed.between(
        F.lit(EARLIEST).cast("timestamp_ntz"), F.lit(LATEST).cast("timestamp_ntz")
    )
    taken = in_range if pattern else text.rlike(TIMESTAMP_TEXT) & in_range
    return F.when(taken, parsed)
