"""Even shards, gapless slots, groups kept together, prefix sums, odd rows."""

import collections
import random
import zlib

import pytest
from pyspark.sql import functions as F

from orderledger.llm import queries, sharding
from tests.llm.conftest import ODD, SF_DIR


def cut(rows):
    """Pairs with equal links in different shards; rows are (link, shard)."""
    both, whole = collections.Counter(rows), collections.Counter(link for link, _ in rows)
    whole.pop(None, None)
    inside = sum(n * n for (link, _), n in both.items() if link is not None)
    return (sum(n * n for n in whole.values()) - inside) // 2


def shards_of(df, shards=24, **options):
    rows = sharding.sharded(df, ["text"], shards, **options).collect()
    by_shard = collections.defaultdict(list)
    for row in rows:
        by_shard[row.shard].append(row.slot)
    sizes = [len(by_shard.get(shard, [])) for shard in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    return [(row.row.text, row.shard) for row in rows]


def least_cut(links, size):
    """No assignment cuts less: groups fill whole shards, and one takes the rest."""
    total = 0
    for n in collections.Counter(links).values():
        parts = [size] * (n // size) + [n % size]
        total += (n * n - sum(p * p for p in parts)) // 2
    return total


def test_groups_stay_together_where_they_fit(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 7)
    rng = random.Random(7)
    texts = [f"single {n}" for n in range(400)]
    for group in range(60):
        texts += [f"group {group}"] * rng.randrange(2, 9)
    rng.shuffle(texts)
    found = shards_of(docs(list(enumerate(texts))))
    assert collections.Counter(text for text, _ in found) == collections.Counter(texts)
    assert cut(found) == 0


def test_a_group_of_a_third_fills_whole_shards(docs):
    texts = ["hot"] * 80 + [f"single {n}" for n in range(160)]
    found = shards_of(docs(list(enumerate(texts))), 12)
    assert cut(found) == least_cut(texts, 20)


def test_without_single_rows_swaps_take_cut_edges_away(docs):
    texts = ["warm"] * 60 + [f"group {n // 4}" for n in range(180)]
    table = docs(list(enumerate(texts)))
    cuts = [cut(shards_of(table, 8, rounds=rounds)) for rounds in (0, 2, 20)]
    assert cuts[2] <= 1.02 * cuts[1] < 0.85 * cuts[0]


@pytest.mark.parametrize("blocks", [1, 3, 50])
def test_prefix_sums(spark, blocks):
    df = spark.range(200).select(
        "id", (F.col("id") % 3).alias("key"), (F.col("id") % 7).alias("value")
    )
    rows = sharding.prefix_sums(
        df, ["key"], ["id"], "value", "before", blocks, -(F.col("id") % 2).cast("int")
    ).collect()
    for key in range(3):
        own = sorted((r for r in rows if r.key == key), key=lambda r: (r.before, r.before + r.value))
        assert sum(r.value for r in own) == own[0]["all"]
        upto = 0
        for r in own:
            assert r.before == upto
            upto += r.value
        odd = [r.before for r in own if r.id % 2 and r.value]
        assert max(odd) < min(r.before for r in own if r.id % 2 == 0 and r.value)


def test_odd_rows(docs):
    rows = sharding.sharded(docs(ODD), ["text"]).collect()
    key = lambda pair: (pair[0] or 0, pair[1] or "")
    assert sorted(((r.row.doc_id, r.row.text) for r in rows), key=key) == sorted(ODD, key=key)
    assert sorted(r.shard for r in rows if r.row.text != "tie")[-1] < 9  # nine rows, 24 shards
    assert {r.row.kept for r in rows} == {"mine"}
    assert sharding.sharded(docs(ODD).limit(0), ["text"]).collect() == []


def test_query(spark, documents):
    found = queries.QUERIES["op11_sharding"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert sorted(r.doc_id for r in found) == sorted(texts)
    sizes = collections.Counter(r.shard for r in found)
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 1
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        assert (r.law, r.grown_shard) == ("rows", None)
    assert cut([(texts[r.doc_id], r.shard) for r in found]) == 0
