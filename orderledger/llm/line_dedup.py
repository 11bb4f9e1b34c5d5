"""Fuzzy line dedup by MinHash.

Lines are compared in lower case with white space turned into one space. Equal lines form a
class, of which the first document's first line stays. Classes whose character-shingle
signatures share a band are candidates; those with a Jaccard similarity of 0.8 or more on their
full shingle sets are linked, and of all classes that links connect, only the one that comes
first stays. "First" goes by document id, then by place in the document.

Lines of little in common share a band now and then: the more lines, the more of them each meets,
until chance alone connects most of a corpus. So a bucket's classes are linked where their sketches
agree as those of similar lines do, and the components of these links are groups. The lines of a
group meet, in chunks where there are many (see `near_duplicates.in_chunks`), and all pairs that
meet are compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import text_groups, written
from orderledger.llm.components import connected_components
from orderledger.llm.near_duplicates import (
    in_chunks,
    pairs_in_tasks,
    spanning_edges,
    whole_tasks,
)

#: Characters of a shingle; a shorter line counts as filled up with spaces.
SHINGLE = 9
#: A link: PERCENT of the union are in both.
PERCENT = 80
#: Ten bands of four values: at a similarity of 0.8 a pair is met with probability 0.995, at
#: 0.85 with 0.9994, and unrelated lines (at most some 0.01) with at most 1e-7.
ROWS, BANDS = 4, 10
_RANDOM = np.random.default_rng(20240518)
_MIX = _RANDOM.integers(0, 2**63, 6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLIERS = _RANDOM.integers(0, 2**31, ROWS * BANDS, dtype=np.uint32) * np.uint32(2)
_MULTIPLIERS += np.uint32(1)
_ADDENDS = _RANDOM.integers(0, 2**32, ROWS * BANDS, dtype=np.uint32)
_BAND_MIX = _RANDOM.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2)
_BAND_MIX += np.uint64(1)

#: A sketch: three bits of each minimum, half of the minima in each of two numbers.
SKETCH_BITS, HALF = 3, ROWS * BANDS // 2
_LOWEST_BITS = sum(1 << SKETCH_BITS * i for i in range(HALF))
_SKETCH_MIX = np.uint32(0x9E3779B1)
#: Minima that agree, at the least, of a candidate's 40. Those of the shared band do; of the 36
#: others 17 do but for a probability of 3e-7 at a similarity of 0.8. Of classes that share a band,
#: 0.05 % pass at a similarity of 0.1, 2 % at 0.2, 19 % at 0.3 and 90 % at 0.5.
AGREE = ROWS + 17
#: Characters that are hashed at a time: what is made of them stays in the processor's cache.
BLOCK = 1 << 14
#: Classes of a bucket whose pairs are written out; those of a larger one are searched.
FEW = 64

#: A component's classes meet its first one in this many tasks' keys.
SALTS = 16
#: Classes that a task remembers to have met.
SEEN = 1 << 18

LINES = (
    "array<struct<no:int,h1:bigint,h2:bigint,bands:array<bigint>,sketch_a:bigint,sketch_b:bigint>>"
)


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def shingle_set(line: str) -> set[str]:
    """The character shingles of a normal line."""
    line = line.ljust(SHINGLE)
    return {line[i : i + SHINGLE] for i in range(len(line) - SHINGLE + 1)}


def _nine_hashes(chars: np.ndarray) -> np.ndarray:
    """64-bit names of all runs of nine characters."""
    two = chars[:-1] * _MIX[0]
    two += chars[1:]
    four = two[:-2] * _MIX[1]
    four += two[2:]
    eight = four[:-4] * _MIX[2]
    eight += four[4:]
    nine = eight[:-1]
    nine *= _MIX[3]
    nine += chars[SHINGLE - 1 :]
    nine ^= nine >> np.uint64(32)
    nine *= _MIX[4]
    return nine


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of all shingles of normal lines, and where each line's begin."""
    lines = [line.ljust(SHINGLE) for line in lines]
    sizes = np.array([len(line) for line in lines], np.int64)
    chars = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    nine = np.empty(len(chars) - SHINGLE + 1, np.uint64)
    for begin in range(0, len(nine), BLOCK):
        end = min(begin + BLOCK, len(nine))
        nine[begin:end] = _nine_hashes(chars[begin : end + SHINGLE - 1].astype(np.uint64))
    inside = np.ones(len(chars), bool)
    inside[(np.cumsum(sizes)[:, None] - np.arange(1, SHINGLE)).ravel()] = False
    counts = sizes - (SHINGLE - 1)
    return nine[inside[: len(nine)]], np.cumsum(counts) - counts


def signatures(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each normal line's band hashes and its sketch, a row each, from minima of its shingles."""
    names, starts = shingle_hashes(lines)
    hashes = (names >> np.uint64(32)).astype(np.uint32)
    mixed = np.empty_like(hashes)
    bands = np.zeros((len(lines), BANDS), np.uint64)
    sketches = np.zeros((len(lines), 2), np.uint64)
    for i in range(ROWS * BANDS):
        np.multiply(hashes, _MULTIPLIERS[i], out=mixed)
        mixed += _ADDENDS[i]
        least = np.minimum.reduceat(mixed, starts)
        band, row = divmod(i, ROWS)
        bands[:, band] += (least.astype(np.uint64) + np.uint64(1)) * _BAND_MIX[band, row]
        half, place = divmod(i, HALF)
        bits = (least * _SKETCH_MIX >> np.uint32(32 - SKETCH_BITS)).astype(np.uint64)
        sketches[:, half] |= bits << np.uint64(SKETCH_BITS * place)
    bands ^= bands >> np.uint64(32)
    bands *= _MIX[5]
    return bands.view(np.int64), sketches.view(np.int64)


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sketches (in the last axis) agree as those of candidates do."""
    other = np.bitwise_xor(a, b).view(np.uint64)
    other |= (other >> np.uint64(1)) | (other >> np.uint64(2))
    other &= np.uint64(_LOWEST_BITS)
    return np.bitwise_count(other).sum(-1) <= ROWS * BANDS - AGREE


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _line_table(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's number of lines, its distinct lines that are not blank, and repeats.

    Bands and sketch come with the first line of a class that a task meets only, which takes most
    copies of frequent lines out of the exchange of buckets. A document without an id lists no
    lines, so it takes no line's bands from others.
    """
    seen: set[int] = set()
    for docs, texts in text_groups(batches, 250_000):
        counts, places, digests, ends, repeats = [], [], [], [0], []
        fresh: dict[int, str] = {}
        for text, known in zip(texts, docs.field("id").is_valid().to_pylist()):
            lines, own, again = text.split("\n") if text else [], {}, []
            for no, line in enumerate(lines if known else []):
                line = normal(line)
                if line:
                    digest = xxhash.xxh3_128_intdigest(line)
                    if digest in own:
                        again.append(no)
                    else:
                        own[digest] = no
                        if digest not in seen:
                            fresh.setdefault(digest, line)
            counts.append(len(lines))
            repeats.append(again)
            places.extend(own.values())
            digests.extend(own)
            ends.append(len(places))
        none = np.empty((0, BANDS), np.int64), np.empty((0, 2), np.int64)
        bands, sketches = signatures(list(fresh.values())) if fresh else none
        rows = {digest: row for row, digest in enumerate(fresh)}
        first = np.array([rows.pop(digest, -1) for digest in digests], np.int64)
        band_ends = np.cumsum(np.append(0, BANDS * (first >= 0))).astype(np.int32)
        picked = bands[first[first >= 0]].ravel()
        sketched = np.zeros((len(first), 2), np.int64)
        sketched[first >= 0] = sketches[first[first >= 0]]
        if len(seen) + len(fresh) > SEEN:
            seen.clear()
        seen.update(fresh)
        entries = pa.StructArray.from_arrays(
            [
                pa.array(places, pa.int32()),
                pa.array([_signed(d >> 64) for d in digests], pa.int64()),
                pa.array([_signed(d & (1 << 64) - 1) for d in digests], pa.int64()),
                pa.ListArray.from_arrays(band_ends, pa.array(picked, pa.int64())),
                pa.array(sketched[:, 0], mask=first < 0),
                pa.array(sketched[:, 1], mask=first < 0),
            ],
            names=["no", "h1", "h2", "bands", "sketch_a", "sketch_b"],
        )
        yield pa.RecordBatch.from_arrays(
            [
                docs,
                pa.array(counts, pa.int64()),
                pa.ListArray.from_arrays(np.array(ends, np.int32), entries),
                pa.array(repeats, pa.list_(pa.int32())),
            ],
            names=["doc", "n_lines", "lines", "repeats"],
        )


def _picked_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The normal lines asked for: `picks` lists (no, h1, grp) for a document's text."""
    for batch in batches:
        h1, groups, lines = [], [], []
        for text, picks in zip(batch.column("text"), batch.column("picks").to_pylist()):
            parts = (text.as_py() or "").split("\n")
            for pick in picks:
                line = normal(parts[pick["no"]]) if pick["no"] < len(parts) else ""
                if line and _signed(xxhash.xxh3_128_intdigest(line) >> 64) == pick["h1"]:
                    h1.append(pick["h1"])
                    groups.append(pick["grp"])
                    lines.append(line)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h1, pa.int64()), pa.array(groups, pa.int64()), pa.array(lines, pa.string())],
            names=["h1", "grp", "line"],
        )


def similar_pairs(
    lines: list[str], columns: int = 8192, left: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the lines whose shingle sets are similar enough, by exact counts.

    With `left`, only pairs of a line on the left with one that is not. Intersections of all pairs
    at once are a matrix product of the lines' shingles, of which those that no pair shares cannot
    count.
    """
    hashes, starts = shingle_hashes(lines)
    owner = np.repeat(np.arange(len(lines)), np.diff(np.append(starts, len(hashes))))
    order = np.argsort(hashes)
    hashes, owner = hashes[order], owner[order]
    # Each shingle's number and line in one number, of which a line's repeats go.
    keys = np.cumsum(np.append(False, hashes[1:] != hashes[:-1])) * len(lines) + owner
    keys.sort()
    names, owner = np.divmod(keys[np.append(True, keys[1:] != keys[:-1])], len(lines))
    sizes = np.bincount(owner, minlength=len(lines))
    if left is None:
        common = np.bincount(names) > 1
    else:
        common = np.bincount(names, left[owner]) * np.bincount(names, ~left[owner]) > 0
    owner, names = owner[common[names]], (np.cumsum(common) - 1)[names[common[names]]]
    at_left = np.arange(len(lines)) if left is None else np.flatnonzero(left)
    at_right = at_left if left is None else np.flatnonzero(~left)
    both = np.zeros((len(at_left), len(at_right)), np.float32)
    for begin in range(0, int(common.sum()), columns):
        part = (names >= begin) & (names < begin + columns)
        rows = np.zeros((len(lines), min(columns, int(common.sum()) - begin)), np.float32)
        rows[owner[part], names[part] - begin] = 1
        both += rows @ rows.T if left is None else rows[at_left] @ rows[at_right].T
    union = sizes[at_left][:, None] + sizes[at_right][None, :] - both
    a, b = np.nonzero(100 * both.astype(np.float64) >= PERCENT * union)
    a, b = at_left[a], at_right[b]
    return (a[a < b], b[a < b]) if left is None else (a, b)


def _confirmed_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact comparison of the lines of each task."""
    for table in whole_tasks(batches, 1024):
        tasks, keys = table["task"].to_numpy(), table["h1"].to_numpy()
        sides = table["side"].to_numpy()
        lines = table["line"].to_pylist()
        found_a, found_b = [], []
        starts = np.flatnonzero(np.r_[True, tasks[1:] != tasks[:-1]]).tolist()
        for start, end in zip(starts, [*starts[1:], len(lines)]):
            side = sides[start:end]
            if side.any():
                a, b = similar_pairs(lines[start:end], left=side < 0)
            elif end - start == 2:
                linked = _similar(*map(shingle_set, lines[start:end]))
                a, b = (np.array([0]), np.array([1])) if linked else ([], [])
            else:
                a, b = similar_pairs(lines[start:end])
            found_a.append(np.asarray(a, np.int64) + start)
            found_b.append(np.asarray(b, np.int64) + start)
        yield spanning_edges(keys, np.concatenate(found_a), np.concatenate(found_b))


def _similar(a: set, b: set) -> bool:
    both = len(a & b)
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _reached(sketches: np.ndarray) -> np.ndarray:
    """Of one bucket's classes, the first that each is connected with over agreeing sketches.

    What a class has reached is not met again, so that similar classes meet but few others.
    """
    heads, left = np.arange(len(sketches)), np.arange(len(sketches))
    while len(left):
        head, reached, left = left[0], left[:1], left[1:]
        while len(reached) and len(left):
            some = max(1, (1 << 18) // len(left))
            meet = agreeing(sketches[reached[:some], None], sketches[None, left]).any(0)
            heads[left[meet]] = head
            reached, left = np.append(reached[some:], left[meet]), left[~meet]
    return heads


def _links(rows: np.ndarray) -> pa.RecordBatch:
    """Links within whole buckets: `rows` are bucket, class and sketch, the buckets in order."""
    starts = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
    sizes = np.diff(np.append(starts, len(rows)))
    few = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= FEW), sizes))
    found_a, found_b = [], []
    for a, b in pairs_in_tasks(rows[few, 0]) if len(few) else ():
        linked = agreeing(rows[few[a], 2:], rows[few[b], 2:])
        found_a.append(few[a[linked]])
        found_b.append(few[b[linked]])
    for start, size in zip(starts[sizes > FEW].tolist(), sizes[sizes > FEW].tolist()):
        found_a.append(start + _reached(rows[start : start + size, 2:]))
        found_b.append(np.arange(start, start + size))
    none = np.empty(0, np.int64)
    return spanning_edges(
        rows[:, 1], np.concatenate([none, *found_a]), np.concatenate([none, *found_b])
    )


def _once_each(rows: np.ndarray) -> np.ndarray:
    """Rows sorted by bucket and class, each once, without buckets of one row but the last."""
    same = rows[1:, 0] == rows[:-1, 0]
    several = np.append(same, False) | np.append(False, same)
    several[-1:] = True
    rows = rows[several]
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[new]


def _bucket_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by bucket, links that connect classes whose sketches agree.

    The buckets stream through: what is kept of them is the last one's classes, once each.
    """
    rest = np.empty((0, 4), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.concatenate([rest, np.stack([column.to_numpy() for column in batch.columns], 1)])
        cut = np.searchsorted(rows[:, 0], rows[-1, 0])
        rest = _once_each(rows[cut:])
        if cut:
            yield _links(_once_each(rows[:cut]))
    if len(rest):
        yield _links(rest)


def candidate_groups(lines: DataFrame) -> DataFrame:
    """h1 and grp of the classes that have a candidate, connected over any number of steps."""
    banded = lines.select(F.explode("bands").alias("bucket"), "h1", "sketch_a", "sketch_b")
    links = (
        banded.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_bucket_links, "a bigint, b bigint")
    )
    return connected_components(links).select(
        F.col("id").alias("h1"), F.col("component").alias("grp")
    )


def line_verdicts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_hash, n_lines and `removed` (sorted places of lines that go), for every row.

    Lines are cut at line feeds; a NULL or empty text has none, blank lines always stay. Rows
    without an id keep all their lines and take none from others. Rows that repeat an id and text
    count as one document, so a repeated row loses the same lines. Other columns are left out; an
    empty table gives an empty table. Equal lines are told by a 128-bit digest.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    key = F.struct("id", F.xxhash64("text").alias("text_hash"))
    found = docs.select(key, "text").mapInArrow(
        _line_table,
        "doc struct<id:bigint,text_hash:bigint>, n_lines bigint, "
        f"lines {LINES}, repeats array<int>",
    )
    found = written(found.select("doc.*", "n_lines", "lines", "repeats"), "lines")
    lines = found.filter("id IS NOT NULL").select(
        "id", "text_hash", F.explode("lines").alias("line")
    )
    lines = lines.select("id", "text_hash", "line.*")
    classes = written(
        lines.groupBy("h1", "h2").agg(
            F.min("id").alias("first_id"),
            F.min_by("no", "id").alias("first_no"),
            (F.count("*") > 1).alias("again"),
        ),
        "line_classes",
    )
    groups = written(classes.join(candidate_groups(lines), "h1"), "line_groups")
    picks = groups.groupBy("first_id").agg(
        F.collect_list(F.struct(F.col("first_no").alias("no"), "h1", "grp")).alias("picks")
    )
    texts = (
        docs.join(picks, F.col("id") == F.col("first_id"))
        .select("text", "picks")
        .mapInArrow(_picked_lines, "h1 bigint, grp bigint, line string")
    )
    sizes = written(groups.groupBy("grp").agg(F.count("*").alias("members")), "group_sizes")
    tasks = in_chunks(texts, "grp", F.col("h1"), sizes, sides=True).repartition("task")
    confirmed = tasks.sortWithinPartitions("task").mapInArrow(
        _confirmed_links, "a bigint, b bigint"
    )
    linked = classes.join(
        connected_components(confirmed).withColumnRenamed("id", "h1"), "h1"
    ).select(
        "h1",
        "h2",
        "component",
        F.struct("first_id", "first_no", "h1").alias("place"),
        F.pmod(F.xxhash64("h1"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    linked = written(linked, "linked_classes")
    heads = linked.groupBy("component").agg(F.min("place").alias("head"))
    heads = heads.withColumn("salt", F.explode(F.expr(f"sequence(0, {SALTS - 1})")))
    later = linked.join(heads, ["component", "salt"]).filter("place > head").select("h1", "h2")
    home = F.when(F.col("later").isNull(), F.col("first_id"))
    # A line that no other equals or precedes is at home where it is.
    homes = classes.join(later.withColumn("later", F.lit(True)), ["h1", "h2"], "left")
    homes = homes.filter("again OR later").select("h1", "h2", home.alias("home"))
    gone = (
        lines.select("id", "text_hash", "no", "h1", "h2")
        .join(written(homes, "line_homes"), ["h1", "h2"])
        .filter("NOT home <=> id")
        .groupBy("id", "text_hash")
        .agg(F.collect_set("no").alias("gone"))
    )
    removed = F.concat("repeats", F.coalesce("gone", F.array().cast("array<int>")))
    none = F.array().cast("array<int>")
    return (
        found.drop("lines")
        .join(written(gone, "lines_gone"), ["id", "text_hash"], "left")
        .select(
            F.col("id").alias(id_col),
            "text_hash",
            "n_lines",
            F.when(F.col("id").isNull(), none).otherwise(F.sort_array(removed)).alias("removed"),
        )
    )


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row` (the whole input row) and `kept_text`, the text without the lines that go.

    A document that has lost lines and has no word left is left out.
    """
    gone = (
        line_verdicts(df, id_col, text_col)
        .filter("size(removed) > 0")
        .select(F.col(id_col).alias("gone"), F.col("text_hash").alias("gone_hash"), "removed")
        .dropDuplicates(["gone", "gone_hash"])
    )
    # The text is in the row: a second copy of it would double what the join moves.
    text = F.col("row")[text_col]
    rows = df.select(
        F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("hash"),
    )
    same = (F.col("id") == F.col("gone")) & (F.col("hash") == F.col("gone_hash"))
    # Arrays of one: their elements are worked out once, however often they are named.
    none = F.col("removed").isNull()
    left = F.transform(
        F.array(F.split(text, "\n")),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "removed"),
                lambda place: F.get(lines, place),
            ),
            "\n",
        ),
    )
    left = F.filter(left, lambda kept: kept.rlike("[^\\x20\\x09-\\x0D]"))
    return rows.join(gone, same, "left").select(
        "row", F.explode(F.when(none, F.array(text)).otherwise(left)).alias("kept_text")
    )
