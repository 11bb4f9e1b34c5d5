"""Frequent keys: a mergeable summary proposes them, a second pass counts them exactly.

The summary is Spark's frequent-items sketch, a Misra-Gries summary with a row for each task. It
tracks `m` counters (a power of two) and is off by 3.5 / m of the rows at most, and it names every key
whose lower bound lies above that error. So a key with more than twice that share is always named:
with 16,384 counters any key above 0.00043 of the rows, and those asked for are above 0.001.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy with more than 1 / SHARE of the rows that have a key, so fewer than SHARE are.
SHARE = 1000
#: Three quarters of 16,384 counters are filled; keys within the error of the least heavy one may be
#: named too, so that up to twice SHARE come back.
TRACKED, NAMED = 12_288, 2 * SHARE


def proposed_keys(df: DataFrame, key: str) -> DataFrame:
    """key, total: a superset of the heavy keys, and the rows that have a key; NAMED rows at most."""
    summary = df.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {NAMED}, {TRACKED})").alias("top"),
        F.count("*").alias("total"),
    )
    return summary.select(F.explode("top.item").alias(key), "total")


def heavy_keys(df: DataFrame, key: str = "order_id") -> DataFrame:
    """key, n, total: every key with more than 1 / SHARE of the rows that have one, counted exactly.

    A missing key is no key. No key is heavy in a table of SHARE rows or fewer unless it repeats.
    """
    proposed = F.broadcast(proposed_keys(df, key))
    counted = df.select(key).join(proposed, key).groupBy(key, "total").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") * SHARE > F.col("total")).select(key, "n", "total")


def copies_of_heavy_keys(df: DataFrame, key: str) -> dict[str, int]:
    """For each heavy key into how many parts its rows are dealt: as many as it has SHAREs.

    Fewer than SHARE keys, and 2 * SHARE parts at most; both come to the driver.
    """
    proposed = proposed_keys(df, key).collect()
    if not proposed:
        return {}
    names, total = [row[0] for row in proposed], proposed[0].total
    counted = df.filter(F.col(key).isin(names)).groupBy(key).agg(F.count("*").alias("n")).collect()
    return {row[0]: -(-row.n * SHARE // total) for row in counted if row.n * SHARE > total}
