"""Each stage against a plain version of what it decides, and the whole run."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from orderledger.llm import language_id, line_dedup, mixing, near_duplicates
from orderledger.llm.common import words_of, written
from tests.llm.conftest import ODD, SF_DIR


@pytest.fixture(scope="module")
def stages(spark, documents):
    """What goes into each stage and what comes out of the last."""
    tables = [documents]
    for name, stage in cp.STAGES:
        tables.append(written(stage(spark, tables[-1], SF_DIR), name))
    return tables


def rows(df):
    return collections.Counter(map(tuple, df.select(cp.COLUMNS).collect()))


def test_columns(stages):
    for table in stages[:-1]:
        assert table.columns == cp.COLUMNS
        assert table.dtypes == stages[0].dtypes
    assert len(cp.STAGES) == 5


def test_language_stage_rejects_what_it_cannot_tell(stages):
    found = {r.doc_id: r for r in language_id.identify(stages[0]).collect()}
    expected = {r: n for r, n in rows(stages[0]).items()
                if found[r[0]].lang_pred != "und" and found[r[0]].score >= cp.LEAST_SCORE}
    assert rows(stages[1]) == expected
    assert len(expected) >= 0.95 * stages[0].count()


def test_language_stage_rejects_noise_and_keeps_clean_texts(spark, documents):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    noise = ["".join(rng.choice(letters) for _ in range(600)) for _ in range(200)]
    made = spark.createDataFrame(
        [(10**9 + n, text, None, "noise", 600) for n, text in enumerate(noise)], documents.schema
    )
    left = cp.language(spark, documents.unionByName(made), SF_DIR)
    assert left.filter("source = 'noise'").count() <= 100
    clean = documents.filter(language_id.held_out(F.col("doc_id")) & F.col("text").rlike("\\p{L}"))
    kept = left.join(clean.select("doc_id"), "doc_id", "left_semi")
    assert kept.count() >= 0.99 * clean.count()


def test_line_stage(stages):
    removed = {r.doc_id: set(r.removed) for r in line_dedup.line_verdicts(stages[1]).collect()}
    expected = collections.Counter()
    for doc, text, lang, source, n in stages[1].select(cp.COLUMNS).collect():
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in removed[doc])
        if not removed[doc] or kept.split():
            expected[doc, kept, lang, source, len(kept) if removed[doc] else n] += 1
    got = rows(stages[2])
    assert {r[:2] for r in got} == {r[:2] for r in expected}
    assert all(r[4] == len(r[1]) for r in got)


def test_near_stage(stages):
    found = near_duplicates.near_duplicates(stages[2]).collect()
    keep = {r.doc_id for r in found if r.kept}
    assert rows(stages[3]) == {r: n for r, n in rows(stages[2]).items() if r[0] in keep}
    groups = collections.Counter(r.component_id for r in found)
    assert len(keep) == len(groups)


def test_mixing_stage(stages):
    size = F.size(words_of(F.col("text")))
    copies = {r.row.doc_id: r.copies for r in mixing.mix(stages[3], size).collect()}
    expected = {r: copies[r[0]] for r in rows(stages[3]) if copies[r[0]]}
    assert rows(stages[4]) == expected


def test_run_returns_what_the_stages_give(spark, stages):
    got = collections.Counter(map(tuple, cp.run(spark, SF_DIR).collect()))
    assert got == collections.Counter(map(tuple, stages[5].collect()))
    assert sum(got.values()) == stages[4].count()


def test_odd_rows_through_all_stages(spark, documents, docs):
    odd = docs(ODD).select("doc_id", "text").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"),
         "n_chars": F.lit(None).cast("bigint")}
    )
    table = documents.limit(40).unionByName(odd)
    for _, stage in cp.STAGES:
        table = written(stage(spark, table, SF_DIR), "odd")
    assert table.count() > 0
    empty = documents.limit(0)
    for _, stage in cp.STAGES:
        empty = written(stage(spark, empty, SF_DIR), "empty")
    assert empty.count() == 0
