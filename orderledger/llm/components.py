"""Connected components: of small edge lists in numpy, of large ones by joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import written


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of the nodes 0 to n - 1 over the edges (a, b)."""
    labels = np.arange(n)
    while True:
        low = np.minimum(labels[a], labels[b])
        before = labels.copy()
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        np.minimum.at(labels, before, labels.copy())
        labels = labels[labels]
        if np.array_equal(before, labels):
            return labels


def _oriented(df: DataFrame) -> DataFrame:
    return df.filter("lo < hi").distinct()


def _moved(edges: DataFrame, end: str, low: DataFrame) -> DataFrame:
    """Edges with `low`, the smallest node known for that end, NULL where nothing changes."""
    return edges.join(low, F.col(end) == F.col("id"), "left").drop("id")


def connected_components(edges: DataFrame) -> DataFrame:
    """`id` and `component` (the smallest id reachable) of every node of the edges (a, b).

    Large-star and small-star steps in turn: a node with neighbours on both sides links its
    larger ones to its smallest, and a node with several smaller neighbours links all of them to
    the smallest, until every component is a star around its smallest node. Only nodes that have
    something to move take part in a step, so that the last steps are small whatever the graph.

    A step's edges are a table of their own: nothing is recomputed and a lost executor costs tasks
    only. No node's edges are gathered: the smallest neighbours are aggregated before the shuffle,
    and the joins with them are of two tables, which Spark splits where a node is hot. Edges with
    a NULL end and loops are left out; no edges, no rows.
    """
    current = written(
        _oriented(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))),
        "edges",
    )
    while True:
        both = current.select(F.col("lo").alias("id"), F.col("hi").alias("other")).unionByName(
            current.select(F.col("hi").alias("id"), F.col("lo").alias("other"))
        )
        between = both.groupBy("id").agg(
            F.min("other").alias("low"), F.max("other").alias("high")
        )
        between = between.filter("low < id AND high > id").select("id", "low")
        between = written(between, "large_star")
        done = between.isEmpty()
        if not done:
            large = _moved(current, "lo", between)
            large = large.select(F.coalesce("low", "lo").alias("lo"), "hi")
            current = written(_oriented(large), "edges")
        several = current.groupBy(F.col("hi").alias("id")).agg(
            F.min("lo").alias("low"), F.max("lo").alias("high")
        )
        several = written(several.filter("low < high").select("id", "low"), "small_star")
        if not several.isEmpty():
            small = _moved(current, "hi", several)
            kept = small.select(F.coalesce("low", "lo").alias("lo"), "hi")
            joined = small.filter("low IS NOT NULL").select("low", F.col("lo").alias("hi"))
            current = written(
                _oriented(kept.unionByName(joined.withColumnRenamed("low", "lo"))), "edges"
            )
        elif done:
            break
    stars = current.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    centres = current.select(F.col("lo").alias("id"), F.col("lo").alias("component"))
    return stars.unionByName(centres.distinct())
