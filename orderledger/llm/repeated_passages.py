"""Exact removal of repeated passages by bucket-pointer refinement of sampled suffixes.

A byte goes if a 100-byte string that covers it also starts earlier. Suffixes are sorted into
buckets by their first bytes only as deep as the answer needs, and a bucket's identifier is a
name made of the identifiers of two shorter ones, the second at a later offset: 8 bytes name
themselves, 16 are named by the names at offsets 0 and 8, then 32, 64 and 100. Names come from
the content, so that tasks agree on them without a global sort, and each name is used by all
deeper ones.

1. Sampling: of the 69 suffixes that start in a 100-byte window and have 32 bytes in it, the one
   with the smallest name is the window's anchor. Equal windows have equal anchors. The windows of
   one anchor are neighbours; their extent is 100 to 168 bytes long.
2. First buckets: the anchors by their 32-byte names. A bucket with one member is finished.
3. Refinement by the names at later offsets: members of a bucket with the same extent are in one
   refined bucket. All but the first have only repeated windows and are finished; the first one
   goes on if its bucket holds another extent, with which it may share some of its windows.
4. Refinement to the full 100 bytes: the windows of those extents, named and compared.

Each step deals rows out by bucket, in which the first document is found. A task first combines
its own rows, so that copies count once a task. A bucket with more than 1/5000 of the anchors of
a sample is hot: its rows are dealt out by refined name at once. The sample chooses how rows are
dealt out, never what is found. Matches rest on two 64-bit names, of bucket and content.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import text_groups, written
from orderledger.llm.near_duplicates import whole_tasks

LENGTH, GRAM = 100, 32
#: Windows an anchor stands for at most.
REACH = LENGTH - GRAM + 1
#: One in so many documents is looked at for hot buckets; hot is a share of 1 / HOT_SHARE, and
#: so there are at most HOT_SHARE hot buckets.
SAMPLE, HOT_SHARE, HOT_LEAST = 64, 5000, 32
_MIX = np.random.default_rng(11).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2)
_MIX += np.uint64(1)
NORMAL, HOT, KNOWN = 0, 1, 2


def _named(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """Names of pairs of names."""
    x = a * _MIX[2 * level]
    x ^= x >> np.uint64(29)
    x += b
    x *= _MIX[2 * level + 1]
    x ^= x >> np.uint64(32)
    return x


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    least, done = values, 1
    while 2 * done <= width:
        least, done = np.minimum(least[:-done], least[done:]), 2 * done
    return np.minimum(least[: len(least) - (width - done)], least[width - done :])


class Suffixes:
    """Names and anchors of some texts' windows; `docs` counts texts, places count bytes."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(text) for text in texts], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.buffer = b"".join(texts)
        n = len(self.buffer)
        self.starts = max(0, n - LENGTH + 1)  # windows, those across texts included
        padded = np.frombuffer(self.buffer + bytes(8), np.uint8)
        eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (n + 1,), (1,))
        sixteen = _named(eight[:-8], eight[8:], 0)
        self.name32 = _named(sixteen[:-16], sixteen[16:], 1)
        self.name64 = _named(self.name32[:-32], self.name32[32:], 2)
        last = np.minimum(self.lengths, LENGTH - 1)
        across = np.zeros(n + 1, np.int64)
        np.add.at(across, self.ends - last, 1)
        np.add.at(across, self.ends, -1)
        self.inside = (np.cumsum(across) == 0)[: self.starts]

    def windows(self) -> np.ndarray:
        """The names of all windows."""
        return _named(self.name64[: self.starts], self.name64[36 : 36 + self.starts], 3)

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")

    def anchors(self) -> tuple[np.ndarray, ...]:
        """First and last window, text, bucket and extent name of every anchor."""
        if not self.inside.any():
            none = np.empty(0, np.int64)
            return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
        least = _sliding_least(self.name32, REACH)[: self.starts]
        new = np.ones(self.starts, bool)
        new[1:] = (least[1:] != least[:-1]) | (self.inside[1:] != self.inside[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], self.starts) - 1
        keep = self.inside[first]
        first, last = first[keep], last[keep]
        # Two texts may meet in a run of equal names, and equal grams may make a run long.
        pieces = (last - first) // REACH + 1
        if (pieces > 1).any():
            at = np.repeat(first, pieces)
            step = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            stop = np.repeat(last, pieces)
            first = at + step * REACH
            last = np.minimum(stop, first + REACH - 1)
        end = last + LENGTH - 64
        name = _named(self.name64[first], self.name64[(first + end) // 2], 4)
        name = _named(name, self.name64[end] + (last - first).astype(np.uint64), 5)
        return first, last, self.doc_of(first), least[first], name

    def smallest_grams(self) -> np.ndarray:
        """Places of the grams that are the smallest of some window."""
        least = _sliding_least(self.name32, REACH)[: self.starts]
        edge = np.full(REACH - 1, np.iinfo(np.uint64).max)
        around = np.concatenate([edge, ~least, edge])
        greatest = ~_sliding_least(around, REACH)
        return np.flatnonzero(self.name32[: len(greatest)] == greatest)

    def named_in_docs(self, docs: np.ndarray, names: np.ndarray, wanted: list) -> np.ndarray:
        """Whether each of the names is among those wanted of its text (a list for each)."""
        counts = [len(w) for w in wanted]
        if not sum(counts):
            return np.zeros(len(names), bool)
        flat = np.concatenate([np.asarray(w, np.int64) for w in wanted]).view(np.uint64)
        own = np.repeat(np.arange(len(wanted)), counts).astype(np.uint64) * _MIX[14]
        return np.isin(names ^ (docs.astype(np.uint64) * _MIX[14]), flat ^ own)


def _combined(keys, names, ids, hot, shared: bool):
    """A task's rows with their kind and the key they are dealt out by.

    Of rows with one key and name only that of the smallest document has to meet other tasks';
    what lies behind it is known to be a repeat and dealt out by document.
    """
    order = np.lexsort((ids, names, keys))
    keys, names, ids = keys[order], names[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
    least = ids[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
    again = np.zeros(len(keys), bool)
    again[1:] = ~new[1:] & (ids[1:] == ids[:-1])
    known = ids != least
    spread = np.ones(len(keys), bool) if shared else np.isin(keys, hot)
    kinds = np.where(known, KNOWN, np.where(spread, HOT, NORMAL)).astype(np.int8)
    dealt = np.where(known, _named(ids.view(np.uint64), names, 6), keys)
    dealt = np.where(spread & ~known, _named(keys, names, 6), dealt)
    keep = ~again
    return dealt[keep].view(np.int64), names[keep].view(np.int64), ids[keep], kinds[keep]


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document ids, and which of them are there."""
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)


def _anchor_rows(hot: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for column, texts in text_groups(batches):
            ids, there = _ids(column)
            _, _, docs, keys, names = Suffixes([text.encode() for text in texts]).anchors()
            own = there[docs]
            rows = _combined(keys[own], names[own], ids[docs[own]], hot, False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in rows], names=["task", "name", "id", "kind"]
            )

    return run


def _first_ids(keys: np.ndarray, names: np.ndarray, ids: np.ndarray):
    """Of rows sorted by key, name, id: where a name begins, and its smallest id."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
    return new, ids[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]


def _judged_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors that are repeats, and first ones with another extent in their bucket."""
    for table in whole_tasks(batches, 1 << 17):
        keys, names, ids = (table[c].to_numpy() for c in ("task", "name", "id"))
        kinds = table["kind"].to_numpy()
        met = kinds != KNOWN
        new, least = _first_ids(keys, names, ids)
        repeat = ~met | (ids != least)
        other_key = np.ones(len(keys), bool)
        other_key[1:] = keys[1:] != keys[:-1]
        bucket = np.cumsum(other_key) - 1
        several = np.bincount(bucket, new & met)[bucket] > 1
        open_ = ~repeat & (several | (kinds == HOT))
        said = repeat | open_
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[said]), pa.array(names[said]), pa.array(open_[said])],
            names=["id", "name", "open"],
        )


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as they are exchanged twice."""
    packer = zstandard.ZstdCompressor(level=1)
    for ids, texts in text_groups(batches):
        packed = [packer.compress(text.encode()) for text in texts]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(packed, pa.binary())], names=["id", "packed"]
        )


def _unpacked(batches: Iterable[pa.RecordBatch], most=2_000_000):
    """Row numbers of a batch and their texts, of bounded size; columns id, packed, more."""
    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        rows, texts, size = [], [], 0
        for row, packed in enumerate(batch.column("packed")):
            texts.append(opener.decompress(packed.as_py()))
            rows.append(row)
            size += len(texts[-1])
            if size >= most or row == batch.num_rows - 1:
                yield batch.take(pa.array(rows)), texts
                rows, texts, size = [], [], 0


def _extent_rows(hot: np.ndarray):
    """The extents that go on, whole; those of hot buckets as names of their windows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _unpacked(batches):
            ids, _ = _ids(batch.column("id"))
            suffixes = Suffixes(texts)
            first, last, docs, keys, names = suffixes.anchors()
            on = suffixes.named_in_docs(docs, names, batch.column("open").to_pylist())
            first, last, docs, keys, names = (x[on] for x in (first, last, docs, keys, names))
            _, once = np.unique(np.stack([docs.astype(np.uint64), names]), axis=1, return_index=True)
            whole = once[~np.isin(keys[once], hot)]
            extents = [suffixes.buffer[a : b + LENGTH] for a, b in zip(first[whole], last[whole])]
            spread = np.flatnonzero(np.isin(keys, hot))
            counts = last[spread] - first[spread] + 1
            steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            places = np.repeat(first[spread], counts) + steps
            dealt = _combined(
                np.repeat(keys[spread], counts),
                suffixes.windows()[places],
                ids[suffixes.doc_of(places)],
                hot,
                True,
            )
            plain = [keys[whole].view(np.int64), names[whole].view(np.int64), ids[docs[whole]]]
            plain.append(np.full(len(whole), NORMAL, np.int8))
            columns = [pa.array(np.concatenate(pair)) for pair in zip(plain, dealt)]
            columns.append(pa.array(extents + [None] * len(dealt[0]), pa.binary()))
            yield pa.RecordBatch.from_arrays(
                columns, names=["task", "name", "id", "kind", "extent"]
            )

    return run


def _judged_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows: places in an extent (name, places), or names (places NULL)."""
    for table in whole_tasks(batches, 1 << 14):
        plain = table.filter(pa.compute.is_valid(table["extent"]))
        if len(plain):
            suffixes = Suffixes(plain["extent"].to_pylist())
            places = np.flatnonzero(suffixes.inside)
            rows = suffixes.doc_of(places)
            names = suffixes.windows()[places]
            keys, ids = plain["task"].to_numpy()[rows], plain["id"].to_numpy()[rows]
            order = np.lexsort((ids, names, keys))
            _, least = _first_ids(keys[order], names[order], ids[order])
            repeat = np.zeros(len(places), bool)
            repeat[order] = ids[order] != least
            own = (suffixes.ends - suffixes.lengths)[rows[repeat]]
            found = np.bincount(rows[repeat], minlength=len(plain))
            ends = np.cumsum(np.append(0, found)).astype(np.int32)
            offsets = pa.array((places[repeat] - own).astype(np.int16))
            some = pa.array(found > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    plain["id"].combine_chunks().filter(some),
                    plain["name"].combine_chunks().filter(some),
                    pa.ListArray.from_arrays(ends, offsets).filter(some),
                ],
                names=["id", "name", "places"],
            )
        spread = table.filter(pa.compute.is_null(table["extent"])).sort_by(
            [("task", "ascending"), ("name", "ascending"), ("id", "ascending")]
        )
        if len(spread):
            keys, names, ids = (spread[c].to_numpy() for c in ("task", "name", "id"))
            _, least = _first_ids(keys, names, ids)
            repeat = (spread["kind"].to_numpy() == KNOWN) | (ids != least)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[repeat]),
                    pa.array(names[repeat]),
                    pa.nulls(int(repeat.sum()), pa.list_(pa.int16())),
                ],
                names=["id", "name", "places"],
            )


def _own_repeats(suffixes: Suffixes, first, last, docs, keys) -> np.ndarray:
    """Windows that start earlier in the same text.

    Both have the same gram as their anchor, so only texts' grams that are the smallest of a
    window at two places are looked at.
    """
    if not len(first):
        return np.empty(0, np.int64)
    salt = _MIX[13]
    places = suffixes.smallest_grams()
    grams = suffixes.name32[places] ^ (suffixes.doc_of(places).astype(np.uint64) * salt)
    grams, counts = np.unique(grams, return_counts=True)
    twin = np.isin(keys ^ (docs.astype(np.uint64) * salt), grams[counts > 1])
    first, last = first[twin], last[twin]
    counts = last - first + 1
    steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    places = np.sort(np.repeat(first, counts) + steps)
    names, texts = suffixes.windows()[places], suffixes.doc_of(places)
    order = np.lexsort((places, names, texts))
    later = np.zeros(len(order), bool)
    later[1:] = (names[order][1:] == names[order][:-1]) & (texts[order][1:] == texts[order][:-1])
    return places[order[later]]


def _removed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's spans of repeated bytes and what is left of it."""
    spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch, texts in _unpacked(batches):
        suffixes = Suffixes(texts)
        first, last, docs, keys, names = suffixes.anchors()
        repeats, parts, windows = (
            [x or [] for x in batch.column(c).to_pylist()] for c in ("repeats", "parts", "windows")
        )
        marks = np.zeros(len(suffixes.buffer) + 1, np.int64)
        gone = suffixes.named_in_docs(docs, names, repeats)
        np.add.at(marks, first[gone], 1)
        np.add.at(marks, last[gone] + LENGTH, -1)
        starts = [_own_repeats(suffixes, first, last, docs, keys)]
        partly = suffixes.named_in_docs(docs, names, [[p["name"] for p in x] for x in parts])
        listed = [{p["name"]: p["places"] for p in x} for x in parts]
        for k in np.flatnonzero(partly):
            places = listed[docs[k]].get(int(names[k].view(np.int64)), ())
            starts.append(first[k] + np.asarray(places, np.int64))
        if any(windows):
            places = np.flatnonzero(suffixes.inside)
            found = suffixes.named_in_docs(
                suffixes.doc_of(places), suffixes.windows()[places], windows
            )
            starts.append(places[found])
        starts = np.concatenate(starts)
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + LENGTH, -1)
        covered = np.cumsum(marks)[:-1] > 0
        kept, spans = [], []
        for end, length, text in zip(suffixes.ends, suffixes.lengths, texts):
            own = covered[end - length : end]
            if own.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                pairs = edges.reshape(-1, 2).tolist()
                spans.append([{"start": a, "end": b} for a, b in pairs])
                kept.append(np.frombuffer(text, np.uint8)[~own].tobytes())
            else:
                spans.append([])
                kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(suffixes.lengths),
                pa.array(spans, spans_kind),
                pa.array(kept, pa.binary()),
            ],
            names=["id", "n_bytes", "spans", "kept"],
        )


ROWS = "task bigint, name bigint, id bigint, kind tinyint"


def hot_buckets(docs: DataFrame) -> np.ndarray:
    """Buckets with over 1/5000 of a sample's anchors: no more than 5000."""
    sample = docs.filter(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0)
    none = np.empty(0, np.uint64)
    counts = written(
        sample.mapInArrow(_anchor_rows(none), ROWS).groupBy("task").count(), "bucket_sample"
    )
    rows = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.filter(F.col("count") >= max(HOT_LEAST, rows / HOT_SHARE)).select("task")
    return np.array([row.task for row in hot.collect()], np.int64).view(np.uint64)


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, n_bytes, `spans` (removed, end exclusive) and `kept` (bytes) of every row.

    A NULL text is empty; texts of fewer than 100 bytes lose nothing. A row without an id loses
    what it repeats itself and is no earlier text of others. Rows that repeat an id are not
    earlier than each other, and lose what other documents have earlier. Other columns are left
    out; an empty table gives an empty table.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    hot = hot_buckets(docs)
    anchors = docs.mapInArrow(_anchor_rows(hot), ROWS).repartition("task")
    judged = anchors.sortWithinPartitions("task", "name", "id").mapInArrow(
        _judged_anchors, "id bigint, name bigint, open boolean"
    )
    listed = written(
        judged.groupBy("id").agg(
            F.collect_list(F.when(F.col("open"), F.col("name"))).alias("open"),
            F.collect_list(F.when(~F.col("open"), F.col("name"))).alias("repeats"),
        ),
        "judged_anchors",
    )
    packed = docs.mapInArrow(_packed, "id bigint, packed binary")
    opened = packed.join(listed.filter("size(open) > 0").select("id", "open"), "id")
    extents = opened.mapInArrow(_extent_rows(hot), f"{ROWS}, extent binary").repartition("task")
    windows = extents.sortWithinPartitions("task").mapInArrow(
        _judged_windows, "id bigint, name bigint, places array<smallint>"
    )
    part = F.when(F.col("places").isNotNull(), F.struct("name", "places"))
    window = F.when(F.col("places").isNull(), F.col("name"))
    parts = written(
        windows.groupBy("id").agg(
            F.collect_list(part).alias("parts"), F.collect_list(window).alias("windows")
        ),
        "judged_windows",
    )
    found = listed.select("id", "repeats").join(parts, "id", "full")
    removed = packed.join(found, "id", "left").mapInArrow(
        _removed,
        "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
    )
    return removed.withColumnRenamed("id", id_col)
