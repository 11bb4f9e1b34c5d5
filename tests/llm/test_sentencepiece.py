"""Ids and texts equal the library's, whatever the text."""

import hashlib

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from orderledger.llm import queries
from orderledger.llm import sentencepiece_codec as codec
from tests.llm.conftest import ODD, SF_DIR

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ALPHABET = "ab the▁\n\t  é😀ß\x00<s>Ａﬁ"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30) | st.text(max_size=30), max_size=5))
def test_table_equals_the_library(texts):
    for entries in (codec.TABLE_ENTRIES, 3):  # the second one is emptied all the time
        table = codec.ChunkTable(PATH, entries)
        for _ in range(2):
            assert [ids.tolist() for ids in table.encode(texts)] == LIBRARY.encode(texts)


def test_words_are_cut_before_runs_of_markers():
    assert codec.marked_words("") == []
    assert codec.marked_words(" ") == ["▁▁"]
    assert codec.marked_words("a b  c ") == ["▁a", "▁b", "▁▁c", "▁"]


def test_operator_on_odd_rows(docs):
    rows = [*ODD, (8, "x" * 100_000)]
    got = sorted(
        ((r.doc_id or 0), r.ids, r.decoded) for r in codec.encode_decode(docs(rows), PATH).collect()
    )
    expected = sorted(
        ((n or 0), LIBRARY.encode(t or ""), LIBRARY.decode(LIBRARY.encode(t or "")))
        for n, t in rows
    )
    assert got == expected
    assert codec.encode_decode(docs([]).limit(0), PATH).collect() == []


def test_query_equals_the_library(spark, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op2_sentencepiece"](spark, SF_DIR).collect()}
    for row in documents.collect():
        ids = LIBRARY.encode(row.text or "")
        found = got[row.doc_id]
        assert found.n_tokens == len(ids)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found.ids_sha256 == digest
        decoded = LIBRARY.decode(ids) if ids else ""
        assert found.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_long_words_leave_the_arrays():
    table, size = codec.ChunkTable(PATH), []
    for k in range(6):
        word = "".join(chr(97 + (i * i + k) % 26) for i in range(50_000))
        assert table.encode([word, "a few words"])[0].tolist() == LIBRARY.encode(word)
        size.append((table.n_words, table.n_ids, len(table.ids)))
    assert len(set(size)) == 1 and size[0][0] == 3


def test_ids_are_bounded():
    table = codec.ChunkTable(PATH, most_ids=200)
    for k in range(50):
        text = " ".join(f"word{k}x{i}" for i in range(20))
        assert table.encode([text])[0].tolist() == LIBRARY.encode(text)
        assert table.n_ids < 200 + 20 * 10


@settings(max_examples=100, deadline=None)
@given(st.text(" ▁ab", max_size=60) | st.text(max_size=60))
def test_long_texts_go_in_parts(text):
    for most in (1, 7):
        assert "".join(codec.text_parts(text, most)) == text
        parts = codec.text_parts(text, most)
        words = [codec.marked_words(part, k == 0) for k, part in enumerate(parts)]
        table = codec.ChunkTable(PATH)
        whole = [int(i) for part in words for ids in table.segment(part) for i in ids]
        assert whole == LIBRARY.encode(text)


def test_digests_are_those_of_the_ids(docs):
    rows = [*ODD, (8, "long words " * 60_000)]
    got = codec.encoded_digests(docs(rows), lambda: PATH).collect()
    real = codec.encode_decode(docs(rows), PATH).collect()
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(
        (
            len(r.ids),
            hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest(),
            hashlib.sha256(r.decoded.encode()).hexdigest(),
        )
        for r in real
    )
