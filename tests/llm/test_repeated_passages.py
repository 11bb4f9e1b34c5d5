"""Removed bytes against all windows, hot buckets, long periods, odd rows."""

import random

import pytest

from orderledger.llm import repeated_passages as rp
from tests.llm.conftest import ODD
from tests.llm.plain import repeats


def found(df):
    return {
        r.doc_id: (bytes(r.kept), [(s.start, s.end) for s in r.spans])
        for r in rp.repeated_passages(df).collect()
    }


def expected(rows):
    rows = sorted((n, (text or "").encode()) for n, text in rows)
    return dict(zip([n for n, _ in rows], repeats([text for _, text in rows])))


@pytest.fixture(params=[False, True], ids=["usual", "hot"])
def dealing(request, monkeypatch):
    """The second one takes every bucket with two anchors as hot."""
    if request.param:
        monkeypatch.setattr(rp, "SAMPLE", 1)
        monkeypatch.setattr(rp, "HOT_LEAST", 2)
        monkeypatch.setattr(rp, "HOT_SHARE", 10**9)


def noise(rng, n):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(n))


def cases(seed):
    rng = random.Random(seed)
    passages = [noise(rng, rng.choice([99, 100, 101, 130, 400])) for _ in range(6)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(4)):
            parts.append(noise(rng, rng.randrange(150)))
            passage = rng.choice(passages)
            cut = rng.randrange(40) if rng.random() < 0.5 else 0
            parts.append(passage[cut:] if rng.random() < 0.5 else passage[: len(passage) - cut])
        texts.append("".join(parts))
    texts += ["ab" * 150, "ab" * 90 + "c", "a" * 300, "a" * 99, "a" * 100, texts[3], texts[3]]
    texts += ["xyz" * 70 + noise(rng, 200) + "xyz" * 70]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(docs, dealing, seed):
    rows = cases(seed)
    assert found(docs(rows).repartition(5)) == expected(rows)


def test_documents_equal_brute_force(documents, dealing):
    rows = [(r.doc_id, r.text) for r in documents.limit(120).collect()]
    few = documents.limit(120)
    assert found(few) == expected(rows)


def test_odd_rows(docs):
    long = "0123456789" * 12
    rows = [*ODD, (8, "y" + long), (9, long), (9, long + "z"), (None, long)]
    got = rp.repeated_passages(docs(rows)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(not r.spans and r.n_bytes == 0 for n in (1, 2) for r in by_id[n])
    assert by_id[5][0].n_bytes == 29 * 4000 and len(by_id[5][0].kept) == 29
    # Rows of one id are not earlier than each other, but 8 is earlier than both.
    assert [bytes(r.kept) for r in by_id[9]].count(b"") >= 1
    assert sorted(bytes(r.kept) for r in by_id[9]) in ([b"", b"z"], [b"", b""])
    # Without an id: only what it repeats itself.
    alone = next(r for r in by_id[None] if r.n_bytes == 120)
    assert [(s.start, s.end) for s in alone.spans] == [(10, 120)]
    assert rp.repeated_passages(docs([]).limit(0)).collect() == []


def test_names_depend_on_the_content_alone():
    text = noise(random.Random(9), 500).encode()
    a, b = rp.Suffixes([text]), rp.Suffixes([b"other " * 30, b"xx" + text])
    shift = 180 + 2
    assert (a.windows() == b.windows()[shift : shift + a.starts]).all()
    assert not b.inside[81:180].any() and b.inside[:81].all()
