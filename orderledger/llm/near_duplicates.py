"""Near-duplicate documents by SetSketch: band registers, estimate by likelihood, verify.

1. Each text becomes the set of its 64-bit word-shingle hashes and a sketch of it. Texts with
   one set form a class; from here on a class counts once, however many copies it has.
2. Classes with one band of registers in common meet in a bucket. Their registers give a joint
   likelihood of the similarity; what may reach the threshold is a candidate link. A bucket
   passes on the links that span its candidates, so never all its pairs.
3. The components of the candidate links are groups outside of which no class has a candidate.
   Each group's sets meet, and pairs that may reach the threshold are compared exactly, most
   similar first, unless they are already linked through others.
4. The components of the confirmed links are the duplicates.

A bucket or group beyond CHUNK members is cut into chunks, each two of which meet in a task of
their own: the work of a group grows with its pairs, but no task does, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import text_groups, written
from orderledger.llm.components import connected_components, local_components
from orderledger.llm.setsketch import BANDS, REGISTERS, ROWS, may_reach, registers

SHINGLE = 5
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Members of a bucket or group that a task takes from each of two chunks.
CHUNK = 256
_MIX = np.random.default_rng(7).integers(0, 2**63, SHINGLE + 2, dtype=np.uint64) * np.uint64(2)
_MIX += np.uint64(1)


def _scrambled(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * _MIX[-1]
    return values ^ (values >> np.uint64(29))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct hashes of the 5-word shingles of each text.

    A text of fewer words has its whole sequence as its one shingle, one without words none.
    """
    words = [text.encode().lower().split() for text in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(
        (xxhash.xxh3_64_intdigest(word) for text in words for word in text),
        np.uint64,
        int(lengths.sum()),
    )
    joined = np.zeros(max(0, len(flat) - SHINGLE + 1), np.uint64)
    for i in range(SHINGLE):
        joined += _scrambled(flat[i : i + len(joined)]) * _MIX[i]
    joined = _scrambled(joined)
    sets, start = [], 0
    for n in lengths:
        if n >= SHINGLE:
            sets.append(np.unique(joined[start : start + n - SHINGLE + 1]))
        elif n:
            short = _scrambled(flat[start : start + n]) * _MIX[:n]
            sets.append(_scrambled(short.sum(keepdims=True) + np.uint64(n)))
        else:
            sets.append(np.empty(0, np.uint64))
        start += n
    return sets


def _set_key(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _sketcher(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_groups(batches, 250_000):
        sets = shingle_sets(texts)
        sizes = np.array([len(s) for s in sets], np.int64)
        starts = np.cumsum(sizes) - sizes
        sketches = np.zeros((len(sets), REGISTERS), np.uint16)
        if sizes.any():
            full = sizes > 0
            sketches[full] = registers(np.concatenate(sets), starts[full])
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(sizes),
                pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([row.tobytes() for row in sketches], pa.binary()),
            ],
            names=["doc", "n", "set_key", "sketch"],
        )


def in_chunks(
    members: DataFrame, key: str, member: Column, sizes: DataFrame, sides: bool = False
) -> DataFrame:
    """Rows dealt to `task`: one for each key, or one for each two chunks of a key with many.

    `sizes` has the key and its number of members; keys not in it are left out. With `sides`,
    `side` tells the chunks of a task apart: -1 and 1, and 0 where it holds one chunk alone.
    """
    chunks = F.ceil(F.col("members") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64(member), F.col("chunks")).cast("int")
    side = F.signum(F.col("own") - F.col("other")).cast("int")
    return (
        members.join(sizes.withColumn("chunks", chunks), key)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .withColumn(
            "task", F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other"))
        )
        .withColumns({"side": side} if sides else {})
        .drop("members", "chunks", "own", "other")
    )


def whole_tasks(batches: Iterable[pa.RecordBatch], most: int = 4096) -> Iterator[pa.Table]:
    """Rows sorted by `task`, cut into tables that hold whole tasks, of some `most` rows."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        while len(rest) > most:
            tasks = rest["task"].to_numpy()
            changes = np.flatnonzero(tasks[1:] != tasks[:-1]) + 1
            if not len(changes):
                break
            cut = int(changes[max(0, np.searchsorted(changes, most, "right") - 1)])
            yield rest.slice(0, cut)
            rest = rest.slice(cut)
    if rest is not None and len(rest):
        yield rest


def pairs_in_tasks(tasks: np.ndarray, most: int = 1 << 16) -> Iterator[tuple]:
    """Row numbers (a, b), a < b, of all pairs within equal tasks, in blocks of some `most`."""
    starts = np.flatnonzero(np.r_[True, tasks[1:] != tasks[:-1]])
    ends = np.r_[starts[1:], len(tasks)]
    last = np.repeat(ends, ends - starts)
    partners = last - np.arange(len(tasks)) - 1
    upto = np.cumsum(partners)
    begin = 0
    while begin < len(tasks):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + most, "right")))
        a = np.repeat(np.arange(begin, end), partners[begin:end])
        first = np.repeat(upto[begin:end] - partners[begin:end] - done, partners[begin:end])
        yield a, a + 1 + np.arange(len(a)) - first
        begin = end


def _sketches(table: pa.Table) -> np.ndarray:
    rows = table["sketch"].to_pylist()
    return np.frombuffer(b"".join(rows), np.uint16).reshape(len(rows), REGISTERS)


def _candidates(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one task that may be linked."""
    tasks, sizes = table["task"].to_numpy(), table["n"].to_numpy()
    sketches, found = _sketches(table), []
    for a, b in pairs_in_tasks(tasks):
        may = may_reach(sketches[a], sketches[b], sizes[a], sizes[b], PERCENT / 100)
        found.append((a[may], b[may]))
    return tuple(np.concatenate(x) for x in zip(*found))


def spanning_edges(reps: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Edges that span the components of the edges (a, b), each to its smallest member."""
    order = np.argsort(reps, kind="stable")
    place = np.empty(len(reps), np.int64)
    place[order] = np.arange(len(reps))
    labels = local_components(len(reps), place[a], place[b])
    low, high = reps[order][labels], reps[order]
    linked = np.unique(np.stack([low, high], 1)[low != high], axis=0)
    return pa.RecordBatch.from_arrays(
        [pa.array(linked[:, 0]), pa.array(linked[:, 1])], names=["a", "b"]
    )


def _candidate_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_tasks(batches):
        yield spanning_edges(table["rep"].to_numpy(), *_candidates(table))


def _similar(a: set, b: set) -> bool:
    both = len(a & b)
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _confirmed_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact comparison of candidate pairs that are not yet connected."""
    for table in whole_tasks(batches, 512):
        reps = table["rep"].to_numpy()
        a, b = _candidates(table)
        sketches = _sketches(table)
        equal = np.concatenate(
            [(sketches[a[i : i + 65536]] == sketches[b[i : i + 65536]]).sum(1)
             for i in range(0, max(1, len(a)), 65536)]
        )
        sets: dict[int, set] = {}
        parent = list(range(len(reps)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def members(x: int) -> set:
            if x not in sets:
                sets[x] = set(table["hashes"][x].values.to_numpy().tolist())
            return sets[x]

        for k in np.argsort(-equal, kind="stable"):
            x, y = int(a[k]), int(b[k])
            if root(x) != root(y) and _similar(members(x), members(y)):
                parent[root(x)] = root(y)
        roots = np.array([root(x) for x in range(len(reps))], np.int64)
        yield spanning_edges(reps, np.arange(len(reps)), roots)


def _set_maker(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of texts, where they are those of the class asked for, once in a run of repeats."""
    names, last = ["rep", "grp", "n", "sketch"], None
    for batch in batches:
        places = pa.array(np.arange(batch.num_rows))
        for at, texts in text_groups(
            [pa.RecordBatch.from_arrays([places, batch.column("text")], names=["at", "text"])]
        ):
            rows, sets, right = batch.take(at), shingle_sets(texts), []
            asked = zip(rows.column("rep").to_pylist(), rows.column("set_key").to_pylist())
            for found, (rep, key) in zip(sets, asked):
                right.append(len(found) > 0 and _set_key(found) == key and last != (rep, key))
                last = (rep, key) if right[-1] else last
            kept = [found.view(np.int64) for found, use in zip(sets, right) if use]
            ends = np.cumsum([0, *map(len, kept)]).astype(np.int32)
            hashes = pa.array(np.concatenate([np.empty(0, np.int64), *kept]))
            rows = rows.filter(pa.array(right, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [*map(rows.column, names), pa.ListArray.from_arrays(ends, hashes)],
                names=[*names, "hashes"],
            )


def _by_task(df: DataFrame, function: Callable) -> DataFrame:
    return df.repartition("task").sortWithinPartitions("task").mapInArrow(function, EDGES)


EDGES = "a bigint, b bigint"
BUCKETS = (
    f"transform(sequence(0, {BANDS - 1}), k -> "
    f"xxhash64(k, substring(sketch, k * {2 * ROWS} + 1, {2 * ROWS})))"
)


def candidate_groups(classes: DataFrame) -> DataFrame:
    """`id` (a class's rep) and `component`: classes that candidate links connect."""
    banded = classes.select("rep", F.explode(F.expr(BUCKETS)).alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    tasks = in_chunks(banded, "bucket", F.col("rep"), written(sizes, "buckets"))
    sketched = tasks.select("task", "rep").join(classes.select("rep", "n", "sketch"), "rep")
    return connected_components(_by_task(sketched, _candidate_links))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id (a whole number), n_shingles, component_id, kept and text_hash, for every row.

    component_id is the smallest id reachable over links; kept is true for that id. Texts that
    are NULL or have no word link with nothing. A row without an id links with nothing, has no
    component and is kept. Rows that repeat an id are judged each by its own text. Other columns
    are left out; an empty table gives an empty table.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    key = F.struct("id", F.xxhash64("text").alias("text_hash"))
    sketches = docs.select(key, "text").mapInArrow(
        _sketcher,
        "doc struct<id:bigint,text_hash:bigint>, n bigint, set_key binary, sketch binary",
    )
    sketched = written(sketches.select("doc.*", "n", "set_key", "sketch"), "sketches")
    full = "id IS NOT NULL AND set_key IS NOT NULL"
    first = F.min(F.struct("id", "n", "sketch")).alias("first")
    classes = written(
        sketched.filter(full)
        .groupBy("set_key")
        .agg(first)
        .select("set_key", F.col("first.id").alias("rep"), "first.n", "first.sketch"),
        "classes",
    )
    groups = candidate_groups(classes).select(
        F.col("id").alias("rep"), F.col("component").alias("grp")
    )
    grouped = written(classes.join(groups, "rep"), "groups")
    sizes = grouped.groupBy("grp").agg(F.count("*").alias("members"))
    sizes = written(sizes, "group_sizes")
    sets = docs.join(grouped, F.col("id") == F.col("rep")).mapInArrow(
        _set_maker, "rep bigint, grp bigint, n bigint, sketch binary, hashes array<bigint>"
    )
    confirmed = _by_task(in_chunks(sets, "grp", F.col("rep"), sizes), _confirmed_links)
    found = connected_components(confirmed)
    component = F.coalesce("component", "rep").alias("component_id")
    of_class = written(
        classes.join(found, F.col("rep") == F.col("id"), "left").select("set_key", component),
        "components",
    )
    wanted = ["id", "n", "component_id", "text_hash"]
    linked = sketched.filter(full).join(of_class, "set_key").select(wanted)
    alone = sketched.filter(f"NOT ({full})").withColumn("component_id", F.col("id"))
    return linked.unionByName(alone.select(wanted)).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
        "text_hash",
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are kept, with all their columns.

    Rows that repeat an id and text are one document, which stays or goes with all its rows.
    """
    found = near_duplicates(df, id_col, text_col).filter("NOT kept")
    gone = found.select(F.col(id_col).alias("gone"), F.col("text_hash").alias("gone_hash"))
    same = (F.col(f"docs.`{id_col}`") == F.col("gone")) & (
        F.xxhash64(F.col(f"docs.`{text_col}`")) == F.col("gone_hash")
    )
    return df.alias("docs").join(gone.distinct(), same, "left_anti")
