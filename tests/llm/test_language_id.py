"""Held-out accuracy, whole texts, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderledger.llm import language_id as li
from tests.llm.conftest import ODD

SAMPLES = {
    "en": "the house is on the hill and the people of the town are there ",
    "de": "das haus steht auf dem hügel und die leute der stadt sind dort ",
    "fr": "la maison est sur la colline et les gens de la ville sont là ",
}


def rows(n=60):
    rng = np.random.default_rng(0)
    found = []
    for k in range(n):
        lang = list(SAMPLES)[k % 3]
        words = SAMPLES[lang].split()
        found.append((k, " ".join(rng.choice(words, 40)), lang))
    return found


@pytest.fixture(scope="module")
def network():
    texts, langs = zip(*((t, lang) for _, t, lang in rows()))
    return li.train(list(texts), list(langs))


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = li.identify(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right >= 0.97
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert ids == {r.doc_id for r in df.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}


def test_all_of_a_text_counts(network):
    text = SAMPLES["de"] * 40 + SAMPLES["en"] * 200
    assert li.predict(network, [text, SAMPLES["de"] * 40])[0] == ["en", "de"]
    windows, owner, sizes = li.windows_of([b"", b"a" * 256, b"b" * 257])
    assert owner.tolist() == [1, 2, 2] and sizes.tolist() == [256, 256, 1]


def test_gradients(network):
    rng = np.random.default_rng(1)
    small = li.train([t for _, t, _ in rows(6)], [lang for _, _, lang in rows(6)])
    small.training = True
    for name in ("embedding", "output", "output_bias"):
        setattr(small, name, getattr(small, name).astype(np.float64))
    small.filters = [f.astype(np.float64) for f in small.filters]
    small.biases = [b.astype(np.float64) for b in small.biases]
    windows, owner, _ = li.windows_of([t.encode() for _, t, _ in rows(6)])
    labels = np.searchsorted(small.languages, [lang for _, _, lang in rows(6)])[owner]

    def loss():
        p = small.probabilities(small.pooled(windows)[0])
        return -np.log(p[np.arange(len(labels)), labels]).mean()

    for weights, gradient in zip(small.arrays(), small.gradients(windows, labels)):
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in weights.shape)
            before = weights[at]
            weights[at] = before + 1e-5
            up = loss()
            weights[at] = before - 1e-5
            down = loss()
            weights[at] = before
            assert (up - down) / 2e-5 == pytest.approx(gradient[at], abs=2e-3)


def test_odd_rows(spark, docs):
    train = spark.createDataFrame([(n + 100, t, lang) for n, t, lang in rows()],
                                  "doc_id bigint, text string, lang string")
    odd = docs([*ODD, (8, "12 ½ ² !!"), (9, "x")]).withColumn("lang", F.lit(None).cast("string"))
    both = train.unionByName(odd.select("doc_id", "text", "lang"))
    out = {r.doc_id: r for r in li.identify(both).collect()}
    assert li.identify(both).count() == 60 + len(ODD) + 2
    for n in (1, 2, 3, 8):
        assert (out[n].lang_pred, out[n].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in out.values())
    assert out[9].lang_pred in SAMPLES and out[None].held_out is False
    assert {r.lang_pred for r in li.identify(odd).collect()} == {"und"}  # nothing to learn from
    assert li.identify(both.limit(0)).collect() == []


def test_predictions_ignore_labels(spark):
    df = spark.createDataFrame(rows(), "doc_id bigint, text string, lang string")
    held = li.held_out(F.col("doc_id"))
    wrong = df.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    one = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(df).collect()}
    assert one == {r.doc_id: (r.lang_pred, r.score) for r in li.identify(wrong).collect()}
