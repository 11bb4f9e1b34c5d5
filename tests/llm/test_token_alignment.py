"""Tokens, links and groups against the libraries and all pairs."""

import collections
import hashlib

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderledger.llm import queries
from orderledger.llm import token_alignment as ta
from tests.llm.conftest import ODD, SF_DIR

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
SIDES = ta.Sides(*PATHS)
ALPHABET = "ab the'sll▁\n\t\x0b  é😀ß\x00<s>12Ａﬁ　​\x1f\xa0"


def plain(text):
    """(token bytes, id) of both sides, by the libraries and their own decoders."""
    if not text:
        return [], []
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    letters = {v: k for k, v in ta.byte_letters().items()}
    back = {letter: byte for byte, letter in letters.items()}
    a_bytes = [bytes(back[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [
        bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i)
        else B.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    raw = b" " + text.encode()
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return [], []
    return list(zip(a_bytes, a)), list(zip(b_bytes, b))


def ranges(tokens):
    at, found = 0, []
    for value, number in tokens:
        found.append((at, at + len(value), number))
        at += len(value)
    return found


def expected(texts):
    pairs, rows = collections.Counter(), []
    for text in texts:
        a, b = map(ranges, plain(text))
        links, k = [], 0
        for start, end, number in a:
            while k and b[k - 1][1] > start:
                k -= 1
            while k < len(b) and b[k][0] < end:
                if b[k][1] > start:
                    links.append((number, b[k][2]))
                k += 1
        pairs.update(links)
        common = sorted({end for _, end, _ in a} & {end for _, end, _ in b})
        groups = [
            "|".join(
                ",".join(str(n) for s, _, n in side if start <= s < end) for side in (a, b)
            )
            for start, end in zip([0, *common[:-1]], common)
        ]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        rows.append((len(a), len(b), len(common), links, digest))
    best = collections.Counter()
    for (_, b_id), n in pairs.items():
        best[b_id] = max(best[b_id], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(pairs[x] == best[x[1]] for x in links),
         sum(pairs[x] for x in links), digest)
        for n_a, n_b, n_groups, links, digest in rows
    ]


def scores(df):
    rows = ta.alignment_scores(df, *PATHS, B.get_piece_size()).collect()
    return [tuple(row) for row in rows]


@settings(max_examples=120, deadline=None)
@given(st.text(ALPHABET, max_size=40) | st.text(max_size=40))
def test_ids_are_those_of_the_libraries(text):
    a, b = plain(text)
    assert [ids.tolist() for ids in SIDES.encode(text)] == [[n for _, n in a], [n for _, n in b]]


@settings(max_examples=120, deadline=None)
@given(st.text(" \n\t▁ab's1", max_size=60), st.sampled_from([1, 5]))
def test_parts_encode_like_the_whole(text, most):
    parts = ta.whole_parts(text, most)
    assert "".join(parts) == text
    if text:
        for side, whole in zip((SIDES.a, SIDES.b),
                               (A.encode(" " + text, add_special_tokens=False).ids, B.encode(text))):
            assert [i for k, part in enumerate(parts) for i in side.encode(part, k == 0)] == whole


def test_odd_rows_and_rare_pairs(docs, monkeypatch):
    rows = [*ODD, (8, "literal ▁ mark"), (9, "<|endoftext|> and </s> are plain"),
            (10, "Ａ full ﬁ width"), (11, "x" * 30_000), (12, "über naïve 😀😀 text\n\n  end ")]
    plain_rows = expected([text for _, text in rows])
    key = lambda row: (row[0] or 0, row[1:])
    table = sorted(((n, *row) for (n, _), row in zip(rows, plain_rows)), key=key)
    for top in (1 << 18, 20, 0):  # the last ones join most pairs or all
        monkeypatch.setattr(ta, "TOP", top)
        assert sorted(scores(docs(rows)), key=key) == table
    assert scores(docs([]).limit(0)) == []


def test_groups_and_links_themselves(docs):
    texts = ["", "alignment of tokenizers", "ünï 😀 x", None]
    found = {r.doc_id: r for r in ta.alignments(docs(list(enumerate(texts))), *PATHS).collect()}
    for n, text in enumerate(texts):
        a, b = map(ranges, plain(text))
        assert found[n].links == [
            (i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] < y[1] and y[0] < x[1]
        ]
        assert [i for group in found[n].groups for i in group.a] == [x[2] for x in a]
        assert [i for group in found[n].groups for i in group.b] == [x[2] for x in b]
        shown = ";".join("|".join(",".join(map(str, g[k])) for k in (0, 1)) for g in found[n].groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if a else ""
        assert digest == expected([text])[0][-1]


def test_query(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = queries.QUERIES["op13_alignment"](spark, SF_DIR).collect()
    table = [(n, *row) for (n, _), row in zip(rows, expected([text for _, text in rows]))]
    assert sorted(map(tuple, found)) == sorted(table)
