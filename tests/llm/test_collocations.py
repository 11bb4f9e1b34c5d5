"""Phrases against the SQL and a plain count, summaries against true counts, odd rows."""

import collections
import os
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderledger.llm import collocations as co
from orderledger.llm import queries
from tests.llm.conftest import ODD, SF_DIR

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, threshold, top, percent=100):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    found = collections.defaultdict(list)
    candidates = {x: f for x, f in counts.items() if f >= threshold and len(x[1]) > 1}
    for (lang, phrase), a in candidates.items():
        longer = [
            f for (other, long), f in candidates.items()
            if other == lang and len(long) > len(phrase)
            and any(long[i : i + len(phrase)] == phrase for i in range(len(long)))
        ]
        if longer and 100 * max(longer) >= percent * a:
            continue
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found[lang].append((-score, -a, " ".join(phrase).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, all_of in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(all_of)[:top], 1)
    )


def got(df, **options):
    return sorted(map(tuple, co.collocations(df, **options).collect()))


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), max_size=40), max_size=6),
    st.integers(1, 6),
    st.integers(2, 60),
)
def test_summaries_keep_every_frequent_name(streams, capacity, threshold):
    true, merged = collections.Counter(), co.Summary(threshold, capacity)
    for stream in streams:
        summary = co.Summary(threshold, capacity)
        for name, n in stream:
            true[name] += n
            summary.add(np.array([name]), np.array([n]))
        merged.merge(summary)
    left = dict(zip(merged.names.tolist(), merged.counts.tolist()))
    assert merged.mass == sum(true.values())
    # Merging adds up what the streams may have lost, which the answer allows for.
    assert all(left.get(x, 0) <= n <= left.get(x, 0) + merged.lost for x, n in true.items())
    if merged.lost < threshold:
        assert {x for x, n in true.items() if n >= threshold} <= set(merged.frequent().tolist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=400), st.integers(1, 5), st.integers(2, 30))
def test_one_stream_loses_less_than_the_threshold(names, capacity, threshold):
    true, summary = collections.Counter(names), co.Summary(threshold, capacity)
    for begin in range(0, len(names), 7):
        part = np.array(names[begin : begin + 7])
        summary.add(part, np.ones(len(part), np.int64))
    assert summary.lost < threshold
    assert {x for x, n in true.items() if n >= threshold} <= set(summary.frequent().tolist())


def test_filter_bits_agree_with_spark(spark):
    names = spark.range(500).select(F.xxhash64("id").alias("name"))
    found = co._filter_of(names)
    own = np.array([r.name for r in names.collect()]).view(np.uint64)
    others = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    assert found.holds(own).all() and found.holds(others).mean() < 0.001


@pytest.mark.parametrize("capacity", [co.CAPACITY, 8])
def test_documents_equal_a_plain_count(spark, documents, monkeypatch, capacity):
    monkeypatch.setattr(co, "CAPACITY", capacity)
    monkeypatch.setattr(co.Summary.__init__, "__defaults__", (co.LEAST, capacity))
    some = documents.filter("lang <> 'en'")
    rows = [(r.lang, r.text) for r in some.collect()]
    assert got(some, threshold=12, top=60) == plain(rows, 12, 60)


def test_overlaps_punctuation_and_odd_rows(docs):
    text = "a a a a a. A a, b c d e f! b c d e f? B\tc  d\x0be f"
    rows = [*ODD, (8, text), (8, text), (9, "x y. " * 30 + "É é " * 5), (10, "tie tie " * 3)]
    df = docs(rows).withColumn("lang", F.when(F.col("doc_id") == 9, "fr"))
    plain_rows = [("fr" if n == 9 else None, t) for n, t in rows]
    assert got(df, threshold=2, top=50, percent=90) == plain(plain_rows, 2, 50, 90)
    assert got(docs([]).withColumn("lang", F.lit(None).cast("string"))) == []


def test_long_texts_are_cut_at_pieces(monkeypatch):
    monkeypatch.setattr(co, "GROUP_CHARS", 10)
    text = "some words, and more words\nand a long piece without any stop " * 3
    whole = co.Texts(co.Words(), [text, "", "next"])
    assert whole.words == co.cut_words(text).split() + [b"..", b"..", b"next", b".."]
    assert whole.ends.tolist() == [len(whole.words) - 3, len(whole.words) - 2, len(whole.words)]


def test_query_equals_sql(spark):
    sf_dir = os.environ.get("TEST_SF_DIR", SF_DIR)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS FROM read_parquet('{sf_dir}/documents.parquet')")
    relation = duck.sql(queries.ORACLES["op12_collocations"])
    found = queries.QUERIES["op12_collocations"](spark, sf_dir)
    assert found.columns == relation.columns
    expected = relation.fetchall()
    assert expected and sorted(map(tuple, found.collect())) == sorted(expected)
