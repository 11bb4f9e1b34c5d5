"""Targets by water filling, copies by systematic sampling, the query's SQL."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F

from orderledger.llm import mixing, queries
from tests.llm.conftest import SF_DIR


def filled(sizes):
    """Reshare the excess by weight until no target is above its cap."""
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {name: k % 3 + 1 for k, name in enumerate(names)}
    targets, left, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        share = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if share * weight[n] > 3 * sizes[n]}
        if not over:
            return targets | {n: share * weight[n] for n in open_}
        for n in over:
            targets[n] = 3.0 * sizes[n]
            left -= 3 * sizes[n]
        open_ -= over
    return targets


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10},
        {"a": 100, "b": 100, "c": 100, "d": 100},
        {"a": 1000, "b": 1, "c": 2, None: 5},
        {"a": 0, "b": 7, "Ä": 900, "é": 3, "z": 0},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(filled(sizes))


def mixed(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, words bigint")
    frame = frame.withColumns({n: F.lit("mine") for n in ("target", "copies", "size", "s", "band")})
    return mixing.mix(frame, F.col("words"))


def test_copies_are_the_expectation_rounded_and_reruns_agree(spark):
    rows = [(n, f"s{n % 5}", 1 + n * n % 97) for n in range(3000)]
    first = mixed(spark, rows).collect()
    again = mixed(spark.newSession(), rows[::-1])
    assert collections.Counter(
        (r.row.doc_id, r.copies) for r in again.repartition(7).collect()
    ) == collections.Counter((r.row.doc_id, r.copies) for r in first)
    taken = collections.Counter()
    for r in first:
        ratio = r.target / r.source_size
        assert int(ratio) <= r.copies <= min(3, int(ratio) + 1)
        taken[r.row.source, r.target] += r.copies * r.size
    assert all(abs(words - target) <= 0.01 * target for (_, target), words in taken.items())


def test_odd_rows(spark):
    rows = [(1, "a", None), (2, "a", 0), (3, None, 5), (None, None, 5), (4, "b", 1), (4, "b", 1)]
    got = mixed(spark, rows).collect()
    assert len(got) == len(rows) and sum(r.size for r in got) == 12
    assert all(r.copies == 0 for r in got if r.row.source == "a")
    assert got[0].row.target == "mine"
    assert mixed(spark, rows).limit(0).collect() == []
    empty = mixing.mix(spark.createDataFrame([], "doc_id bigint, source string"), F.lit(1))
    assert empty.collect() == []


def test_emit_repeats_whole_rows(spark):
    rows = [(n, "a" if n % 9 else "b", 10) for n in range(900)]
    found = mixed(spark, rows)
    counts = {r.row.doc_id: r.copies for r in found.collect()}
    emitted = collections.Counter(r.doc_id for r in mixing.emit(found).collect())
    assert emitted == {n: c for n, c in counts.items() if c}
    assert mixing.emit(found).columns[:3] == ["doc_id", "source", "words"]


def test_a_hot_source_is_dealt_to_many_groups(spark):
    rows = spark.range(20000).select(
        F.col("id"), F.lit("hot").alias("source"), F.lit(7).alias("size"), F.lit(400000).alias("units")
    )
    sampled = mixing.systematic_sample(rows)
    assert sampled.agg(F.sum("copies")).first()[0] in (7999, 8000, 8001)


def test_query_equals_its_sql(spark):
    df = queries.QUERIES["op4_mixing"](spark, SF_DIR)
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_DIR}/documents.parquet')"
    )
    relation = connection.sql(queries.ORACLES["op4_mixing"])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    got = collections.Counter(map(tuple, df.select(columns).collect()))
    assert got == collections.Counter(relation.select(*columns).fetchall())
