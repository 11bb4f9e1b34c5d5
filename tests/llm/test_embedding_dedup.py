"""Links and groups against all pairs, blocks, odd vectors."""

import numpy as np
import pytest

from orderledger.llm import embedding_dedup as ed
from tests.llm.conftest import SF_DIR
from tests.llm.plain import Union

SCHEMA = "vec_id bigint, embedding array<float>"


def expected(rows):
    ids = [n for n, _ in rows]
    x = np.array([np.float32(v) for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= ed.THRESHOLD
    np.fill_diagonal(near, False)
    union = Union()
    for a, b in zip(*np.nonzero(near)):
        union.join(ids[a], ids[b])
    return {n: (int(near[k].sum()), union.find(n), union.find(n) == n) for k, n in enumerate(ids)}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ed.near_vectors(df).collect()}


def clustered(seed, n=400, width=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width))
    picked = centres[rng.integers(0, 12, n)]
    x = np.where(rng.random((n, 1)) < 0.5, picked, rng.standard_normal((n, width)))
    x = x + rng.standard_normal((n, width)) * rng.choice([0.0, 0.1, 0.3], (n, 1))
    return [(int(k), [float(v) for v in row]) for k, row in enumerate(x)]


@pytest.mark.parametrize("block, cell", [(256, 400), (8, 20)])
def test_equals_brute_force(spark, monkeypatch, block, cell):
    monkeypatch.setattr(ed, "BLOCK", block)
    monkeypatch.setattr(ed, "CELL_ROWS", cell)
    monkeypatch.setattr(ed, "MARGIN", 2.0)  # every cell is visited, so that no pair is missed
    rows = clustered(5)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == expected(rows)


def test_recall_with_the_usual_margin(spark, monkeypatch):
    monkeypatch.setattr(ed, "CELL_ROWS", 20)
    rows = clustered(6, 1500)
    got, plain = found(spark.createDataFrame(rows, SCHEMA)), expected(rows)
    links = sum(n for n, _, _ in plain.values())
    assert links > 1000
    assert sum(n for n, _, _ in got.values()) >= 0.95 * links
    assert all(got[k][0] <= plain[k][0] for k in plain)


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    assert found(df) == expected([(r.vec_id, r.embedding) for r in df.collect()])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]),
        (None, [1.0, 0.0]), (11, [1e38, 1e38]), (12, [1e-38, 1e-38]), (13, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS label", "3 AS rep")
    got = ed.near_vectors(df).collect()
    assert len(got) == len(rows)
    by_id = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    for n in (1, 2, 3, 4, 5, 6, 10, 13):
        assert by_id[n] == (0, n, True)
    assert by_id[7] == (3, 7, True) and by_id[8] == (3, 7, False) and by_id[9] == (3, 7, False)
    assert by_id[11] == (1, 11, True) and by_id[12] == (1, 11, False)
    assert by_id[None] == (0, None, True)
    assert ed.near_vectors(df.limit(0)).collect() == []
