"""Verdicts on lines against all pairs, chunks, odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from orderledger.llm import line_dedup as ld
from orderledger.llm import near_duplicates as nd
from tests.llm.conftest import ODD
from tests.llm.plain import Union, components


def expected(rows):
    """Places that go: of linked classes all but the first, and every later copy."""
    first = {}
    for n, text in sorted(rows, key=lambda row: row[0]):
        for no, line in enumerate((text or "").split("\n")):
            if ld.normal(line):
                first.setdefault(ld.normal(line), (n, no))
    order = sorted(first, key=first.get)
    heads = components({k: ld.shingle_set(line) for k, line in enumerate(order)}, ld.PERCENT)
    stays = {line: heads[k] == k for k, line in enumerate(order)}
    gone = {}
    for n, text in rows:
        gone[n] = [
            no
            for no, line in enumerate((text or "").split("\n") if text else [])
            if ld.normal(line)
            and not (stays[ld.normal(line)] and first[ld.normal(line)] == (n, no))
        ]
    return gone


def found(df):
    return {r.doc_id: list(r.removed) for r in ld.line_verdicts(df).collect()}


def test_documents_equal_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got, plain = found(documents), expected(rows)
    # Bands meet a pair at the threshold with probability 0.995; no line goes without a link.
    missed = [n for n in plain if got[n] != plain[n]]
    assert len(missed) <= 0.01 * len(plain)
    assert all(set(got[n]) <= set(plain[n]) for n in plain)


def near_line(rng, line):
    at = rng.randrange(len(line))
    return line[:at] + rng.choice("xyz") + line[at + 1 :]


@pytest.mark.parametrize("chunk", [8, 256])
def test_a_large_group_of_near_lines(docs, monkeypatch, chunk):
    monkeypatch.setattr(nd, "CHUNK", chunk)
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(240)).strip()
    rows = [(n, near_line(rng, base) + f"\nonly {n} {rng.random()}") for n in range(80)]
    got = found(docs(rows))
    assert got[0] == [] and all(got[n] == [0] for n in range(1, 80))


def test_similar_pairs_equal_sets():
    rng = random.Random(3)
    lines = ["".join(rng.choice("ab ") for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    lines += [near_line(rng, lines[k]) for k in range(60)] + ["", "a", "a "]
    a, b = ld.similar_pairs(lines, columns=16)
    sets = [ld.shingle_set(line) for line in lines]
    plain = {(x, y) for y in range(len(sets)) for x in range(y) if ld._similar(sets[x], sets[y])}
    assert set(zip(a.tolist(), b.tolist())) == plain


def test_case_space_order_and_repeats(docs):
    rows = [(2, "Same  LINE here\n\nother"), (1, "same line here\nsame line HERE"), (3, "\n \nother ")]
    assert found(docs(rows)) == {1: [1], 2: [0], 3: [2]}


def test_odd_rows(docs):
    rows = ld.line_verdicts(docs([*ODD, (None, "tie"), (8, "tie\nmore")])).collect()
    assert len(rows) == len(ODD) + 2
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.n_lines, list(r.removed)))
    assert by_id[1] == [(0, [])] and by_id[2] == [(0, [])] and by_id[3] == [(2, [])]
    assert by_id[None] == [(1, []), (1, [])]
    assert by_id[6] == [(1, [])] and by_id[7] == [(1, [0])] * 2 and by_id[8] == [(2, [0])]
    assert ld.line_verdicts(docs([]).limit(0)).collect() == []


def test_documents_without_id_take_no_bands(docs):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefgh ") for _ in range(240)).strip()
    rows = [(None, base), (1, base), (2, near_line(rng, base)), (None, base)]
    got = {r.doc_id: (r.n_lines, list(r.removed))
           for r in ld.line_verdicts(docs(rows).coalesce(1)).collect()}
    assert got == {None: (1, []), 1: (1, []), 2: (1, [0])}


def test_texts_without_their_lines(docs):
    df = docs([(1, "a line of text\nanother\n\nlast"), (2, "a line of text"), (3, "new\nanother"),
               (4, None), (5, " \n"), (5, " \n")])
    left = ld.dedup_lines(df)
    got = sorted((r.row.doc_id, r.kept_text) for r in left.collect() if r.kept_text is not None)
    assert got == [(1, "a line of text\nanother\n\nlast"), (3, "new"), (5, " \n"), (5, " \n")]
    assert left.count() == 5 and left.first().row.n == "mine"
    assert ld.dedup_lines(docs([]).limit(0)).collect() == []


def test_union_keeps_the_first():
    union = Union()
    union.join(3, 1)
    union.join(2, 3)
    assert union.find(2) == 1


def test_chance_does_not_connect_lines(docs):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 7))) for _ in range(12)]
    lines = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(3000)]
    lines += [near_line(rng, line) for line in lines[:200]]
    df = docs([(n, line) for n, line in enumerate(lines)])
    key = ld.F.struct(ld.F.col("doc_id").alias("id"), ld.F.xxhash64("text").alias("text_hash"))
    found = df.select(key, "text").mapInArrow(
        ld._line_table,
        "doc struct<id:bigint,text_hash:bigint>, n_lines bigint, "
        f"lines {ld.LINES}, repeats array<int>",
    )
    rows = found.select("doc.id", ld.F.explode("lines").alias("line")).select("id", "line.*")
    rows = rows.localCheckpoint()
    groups = {r.h1: r.grp for r in ld.candidate_groups(rows).collect()}
    classes = {r.id: r.h1 for r in rows.collect()}
    sizes = {}
    for group in groups.values():
        sizes[group] = sizes.get(group, 0) + 1
    assert max(sizes.values()) < 30
    together = [n for n in range(200) if classes[n] == classes[3000 + n]
                or groups.get(classes[n], n) == groups.get(classes[3000 + n])]
    assert len(together) >= 198


def test_links_of_a_searched_bucket_connect_what_pairs_connect(monkeypatch):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    bases = [[rng.choice(words) for _ in range(20)] for _ in range(4)]
    lines = [" ".join(rng.choice(words) if rng.random() < 0.15 else word for word in bases[n % 4])
             for n in range(120)]
    _, sketches = ld.signatures(lines)
    names = np.array(rng.sample(range(-10**6, 10**6), len(lines)))
    buckets = np.where(np.arange(len(lines)) < 90, 5, 7)
    rows = ld._once_each(np.concatenate([np.stack([buckets, names], 1), sketches], 1))
    linked = []
    for few in (1000, 1):
        monkeypatch.setattr(ld, "FEW", few)
        union = Union()
        for edge in ld._links(rows).to_pylist():
            union.join(edge["a"], edge["b"])
        linked.append({int(name): union.find(int(name)) for name in names})
    assert linked[0] == linked[1] and 4 < len(set(linked[0].values())) < 60


def test_pairs_across_two_sides():
    rng = random.Random(7)
    lines = ["".join(rng.choice("ab ") for _ in range(rng.randrange(1, 60))) for _ in range(50)]
    lines += [near_line(rng, line) for line in lines]
    left = np.array([rng.random() < 0.5 for _ in lines])
    a, b = ld.similar_pairs(lines)
    plain = {(x, y) if left[x] else (y, x) for x, y in zip(a, b) if left[x] != left[y]}
    a, b = ld.similar_pairs(lines, columns=16, left=left)
    assert set(zip(a, b)) == plain and plain


def test_buckets_go_on_in_later_batches():
    rng = random.Random(8)
    rows = np.array([(bucket, rng.randrange(4), 1, 1) for bucket in sorted(
        rng.randrange(40) for _ in range(300))], np.int64)
    rows[:, 2:] = rows[:, 1:2]
    whole = ld._links(ld._once_each(rows)).to_pylist()
    names = ["bucket", "h1", "sketch_a", "sketch_b"]
    table = pa.Table.from_arrays([pa.array(column) for column in rows.T], names=names)
    batches = [table.schema.empty_table().to_batches(), table.to_batches(7)]
    found = [edge for batch in ld._bucket_links([b for x in batches for b in x])
             for edge in batch.to_pylist()]
    assert {(e["a"], e["b"]) for e in found} >= {(e["a"], e["b"]) for e in whole}
    assert {x for e in found for x in e.values()} <= {0, 1, 2, 3}


def test_a_text_is_cut_into_lines_once(docs):
    left = ld.dedup_lines(docs([(1, "a line of text\nanother"), (2, "a line of text\nmore")]))
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and "explode(" in plan
