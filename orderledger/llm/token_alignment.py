"""Alignment of two tokenizers by the bytes that their tokens cover.

A is a byte-level BPE that gets a space and the text, B a SentencePiece model that puts the space
there itself; both give back the same bytes, or the text has no tokens. Starts are places in the
bytes of all documents of a batch, one behind the other.

1. Each token start finds the other side's covering token: `merge_asof`, keyed by document, from A
   to B and from B to A. The union of both directions is all pairs of tokens that overlap, the
   links; where two starts are equal both directions find the same one.
2. Ends that both sides have cut the tokens into groups.
3. Each document's links are written as its distinct pairs of ids and how often it links them. How
   many links hold a pair is counted over the corpus: within a task first, then by pair.
4. Each document's pairs are looked up in these counts. The TOP most frequent pairs go to every task,
   and links of other pairs are joined with the rest of the counts; no such pair has more than
   1 / TOP of the links. The highest count of each id of B is a list as long as B's vocabulary.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import text_groups, written
from orderledger.llm.sentencepiece_codec import GROUP_CHARS, MARK, text_parts

#: Pairs whose counts go to every task, 17 bytes each.
TOP = 1 << 18
#: Tokens of one side that are grouped at once, and pairs that a task looks up or adds up at once.
GROUP_TOKENS, GROUP_PAIRS = 200_000, 1_000_000
#: Fixed value: how byte-level BPE cuts a text before it merges.
CUTS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

Path = str | Callable[[], str]


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary.

    Bytes that Latin-1 prints stand for themselves, the others for the letters from 256 on.
    """
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printed]
    letters = {chr(byte): byte for byte in printed}
    return letters | {chr(256 + k): byte for k, byte in enumerate(others)}


class ByteLevel:
    """Byte-level BPE from the file of its tokenizer, whose special tokens are plain text here."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, cutter = whole["model"], whole["pre_tokenizer"]
        letters, vocabulary = byte_letters(), model["vocab"]
        special = {token["id"] for token in whole["added_tokens"] if token["special"]}
        merged = [vocabulary["".join(pair)] for pair in model["merges"]]
        plain = (
            model["type"] == "BPE"
            and whole["normalizer"] is None
            and cutter["type"] == "ByteLevel"
            and cutter["use_regex"]
            and not cutter["add_prefix_space"]
            # Merging by id is merging by rank only if the ids are in the order of the merges.
            and merged == sorted(merged)
        )
        if not plain:
            raise ValueError(f"{path} is no byte-level BPE whose ids follow its merges")
        self.ranks = {
            bytes(letters[letter] for letter in entry): number
            for entry, number in vocabulary.items()
            if number not in special
        }
        if any(bytes([byte]) not in self.ranks for byte in range(256)):
            raise ValueError(f"{path} has no token for some byte, so texts are not given back")
        self.bytes = [b""] * (max([*self.ranks.values(), *special]) + 1)
        for entry, number in self.ranks.items():
            self.bytes[number] = entry

    @cached_property
    def model(self):
        import tiktoken

        return tiktoken.Encoding(
            "byte_level", pat_str=CUTS, mergeable_ranks=self.ranks, special_tokens={}
        )

    def encode(self, part: str, first: bool) -> list[int]:
        return self.model.encode_ordinary(" " + part if first else part)


class Pieces:
    """A SentencePiece model; it puts a space in front of a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.mark = self.model.piece_to_id(MARK)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(piece[3:5], 16)])
            if self.model.is_byte(i)
            else piece.replace(MARK, " ").encode()
            for i, piece in enumerate(pieces)
        ]

    def encode(self, part: str, first: bool) -> list[int]:
        if first:
            return self.model.encode(part, num_threads=1)
        return self.model.encode(part[1:], num_threads=1) or [self.mark]


class Sides:
    """Both tokenizers, and the lengths of their tokens in bytes."""

    def __init__(self, a_path: Path, b_path: Path):
        paths = [path() if callable(path) else path for path in (a_path, b_path)]
        self.a, self.b = ByteLevel(paths[0]), Pieces(paths[1])
        self.lengths = [np.array(list(map(len, side.bytes))) for side in (self.a, self.b)]
        self.kinds = [
            np.dtype("<u2" if len(side.bytes) <= 1 << 16 else "<u4") for side in (self.a, self.b)
        ]

    def encode(self, text: str | None) -> list[np.ndarray]:
        """The ids of A and B, none where B does not give back space and text; A always does."""
        none = [np.empty(0, kind) for kind in self.kinds]
        if not text:
            return none
        parts = whole_parts(text)
        found = []
        for side, kind in zip((self.a, self.b), self.kinds):
            ids = [side.encode(part, k == 0) for k, part in enumerate(parts)]
            ids = ids[0] if len(ids) == 1 else [i for part in ids for i in part]
            if side is self.b and b"".join(map(side.bytes.__getitem__, ids)) != b" " + text.encode():
                return none
            found.append(np.array(ids, kind))
        return found


def whole_parts(text: str, most: int = GROUP_CHARS) -> list[str]:
    """Parts of a long text that both sides encode as in the whole.

    A part ends before a space that follows no white space: there ends a word of either side.
    """
    whole: list[str] = []
    for part in text_parts(text, most):
        if whole and whole[-1][-1].isspace():
            whole[-1] += part
        else:
            whole.append(part)
    return whole


class Batch:
    """Tokens of some documents, aligned."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], lengths: list[np.ndarray]):
        self.docs = len(a)
        self.ids, self.doc, self.end = [], [], []
        for side, length in zip((a, b), lengths):
            ids = np.concatenate([np.empty(0, np.int64), *side]).astype(np.int64)
            self.ids.append(ids)
            self.doc.append(np.repeat(np.arange(self.docs), [len(x) for x in side]))
            self.end.append(np.cumsum(length[ids]))
        self.start = [end - length[ids] for end, length, ids in zip(self.end, lengths, self.ids)]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the A and the B token of every pair that overlaps."""
        a, b = (
            pd.DataFrame({"start": start, "doc": doc, name: np.arange(len(doc))})
            for name, start, doc in zip("ab", self.start, self.doc)
        )
        forth = pd.merge_asof(a, b, on="start", by="doc")
        # Where starts are equal the way back finds what the way forth has found.
        other = ~self._among(self.start[1], self.start[0])
        back = pd.merge_asof(b[other], a, on="start", by="doc")
        return tuple(
            np.concatenate([forth[x].to_numpy(), back[x].to_numpy()]).astype(np.int64) for x in "ab"
        )

    def _among(self, places: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Which of some places in the bytes are among the others."""
        there = np.zeros(max((int(end[-1]) for end in self.end if len(end)), default=0) + 1, bool)
        there[others] = True
        return there[places]

    @cached_property
    def closing(self) -> list[np.ndarray]:
        """Whether a token's end is one of the other side too, for both sides."""
        return [self._among(mine, other) for mine, other in (self.end, self.end[::-1])]

    def codes(self, sizes: list[int]) -> np.ndarray:
        """Tokens group by group, A's first, as numbers: id, B's behind twice A's vocabulary.

        The last token of a side of a group has the size of that side's vocabulary added.
        """
        closing = self.closing
        groups = [np.cumsum(ends) - ends for ends in closing]
        number = int(closing[0].sum())
        counts = [np.bincount(group, minlength=number) for group in groups]
        before = [np.cumsum(count) - count for count in counts]
        a_at = np.arange(len(groups[0])) + before[1][groups[0]]
        b_at = np.arange(len(groups[1])) + (before[0] + counts[0])[groups[1]]
        codes = np.empty(len(a_at) + len(b_at), np.int64)
        for at, ids, last, size, first in zip(
            (a_at, b_at), self.ids, closing, sizes, (0, 2 * sizes[0])
        ):
            codes[at] = ids + last * size + first
        return codes

    def per_doc(self, docs: np.ndarray) -> np.ndarray:
        return np.bincount(docs, minlength=self.docs).astype(np.int64)


def _small_batches(
    batches: Iterable[pa.RecordBatch], sides: Sides
) -> Iterator[tuple[pa.RecordBatch, Batch]]:
    """Rows with the packed ids `a` and `b`, some GROUP_TOKENS of a side at once."""
    for rows in batches:
        packed = [rows.column(name) for name in ("a", "b")]
        begin, ids, size = 0, [[], []], 0
        for at in range(rows.num_rows):
            for own, column, kind in zip(ids, packed, sides.kinds):
                own.append(np.frombuffer(column[at].as_buffer(), kind))
            size += max(len(own[-1]) for own in ids)
            if size >= GROUP_TOKENS or at + 1 == rows.num_rows:
                yield rows.slice(begin, at + 1 - begin), Batch(*ids, sides.lengths)
                begin, ids, size = at + 1, [[], []], 0


def _encoder(a_path: Path, b_path: Path) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(a_path, b_path)
        for keys, texts in text_groups(batches, GROUP_CHARS):
            a, b = zip(*map(sides.encode, texts))
            yield pa.RecordBatch.from_arrays(
                [keys.field("row"), keys.field("id")]
                + [pa.array([ids.tobytes() for ids in side], pa.binary()) for side in (a, b)],
                names=["row", "id", "a", "b"],
            )

    return run


def _written_rows(
    df: DataFrame, function: Callable, columns: str, purpose: str, id_col: str, text_col: str
) -> DataFrame:
    """What a function makes of keys and texts, written; `row` tells all rows apart."""
    key = F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"))
    docs = df.select(key.alias("key"), F.col(text_col).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    made = docs.mapInArrow(function, f"row bigint, id {kind}, {columns}")
    return written(made, purpose, compression="zstd")


def token_table(
    df: DataFrame, a_path: Path, b_path: Path, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """row, id, a, b: the packed ids of every row, written."""
    encoder = _encoder(a_path, b_path)
    return _written_rows(df, encoder, "a binary, b binary", "tokens", id_col, text_col)


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
#: How pairs, and how often a document links them, are packed.
PAIR, TIMES = np.dtype("<i8"), np.dtype("<i4")


def _pairs_of_docs(
    doc: np.ndarray, pairs: np.ndarray, docs: int, most: int
) -> list[tuple[bytes, bytes]]:
    """The distinct pairs (below `most`) of each document and how many of its links hold each."""
    keys = np.sort(doc * most + pairs)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(keys))).astype(TIMES)
    doc, pairs = np.divmod(keys[at], most)
    cuts = np.cumsum([0, *np.bincount(doc, minlength=docs)]).tolist()
    pairs = pairs.astype(PAIR)
    return [(pairs[i:j].tobytes(), times[i:j].tobytes()) for i, j in zip(cuts[:-1], cuts[1:])]


def _aligner(a_path: Path, b_path: Path) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(a_path, b_path)
        wide, sizes = len(sides.b.bytes), [len(side.bytes) for side in (sides.a, sides.b)]
        # The text of each id inside its side of a group, and at its end.
        texts = [f"{i}{mark}" for size, last in zip(sizes, "|;") for mark in f",{last}"
                 for i in range(size)]
        for keys, group in text_groups(batches, GROUP_CHARS):
            batch = Batch(*zip(*map(sides.encode, group)), sides.lengths)
            a, b = batch.links()
            doc = batch.doc[0][a]
            pairs = batch.ids[0][a] * wide + batch.ids[1][b]
            packed = _pairs_of_docs(doc, pairs, batch.docs, wide * sizes[0])
            shown = list(map(texts.__getitem__, batch.codes(sizes).tolist()))
            n_a, n_b = (batch.per_doc(docs) for docs in batch.doc)
            cuts = np.cumsum([0, *(n_a + n_b)]).tolist()
            digests = [
                hashlib.sha256("".join(shown[i:j])[:-1].encode()).hexdigest() if j > i else ""
                for i, j in zip(cuts[:-1], cuts[1:])
            ]
            groups = batch.per_doc(batch.doc[0][batch.closing[0]])
            yield pa.RecordBatch.from_arrays(
                [
                    keys.field("row"),
                    keys.field("id"),
                    *map(pa.array, (n_a, n_b, groups, batch.per_doc(doc))),
                    pa.array(digests, pa.string()),
                    *(pa.array(column, pa.binary()) for column in zip(*packed)),
                ],
                names=["row", "id", *NUMBERS, "groups_sha256", "pairs", "times"],
            )

    return run


def aligned_table(
    df: DataFrame, a_path: Path, b_path: Path, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """row, id, the NUMBERS, groups_sha256, and the packed pairs and times of every row, written."""
    numbers = ", ".join(f"{name} bigint" for name in NUMBERS)
    return _written_rows(
        df,
        _aligner(a_path, b_path),
        f"{numbers}, groups_sha256 string, pairs binary, times binary",
        "aligned",
        id_col,
        text_col,
    )


def _pair_groups(
    batches: Iterable[pa.RecordBatch],
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, the number of pairs of each, and their pairs and times, some GROUP_PAIRS at once."""

    def unpacked(rows: pa.RecordBatch) -> tuple:
        pairs, times = (
            np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)
            for name, kind in (("pairs", PAIR), ("times", TIMES))
        )
        counts = pc.binary_length(rows.column("pairs")).to_numpy() // PAIR.itemsize
        return rows, counts, pairs, times

    for rows in batches:
        lengths = pc.binary_length(rows.column("pairs")).to_numpy() // PAIR.itemsize
        begin, size = 0, 0
        for at, length in enumerate(lengths.tolist()):
            size += length
            if size >= GROUP_PAIRS or at + 1 == rows.num_rows:
                yield unpacked(rows.slice(begin, at + 1 - begin))
                begin, size = at + 1, 0


def _added_up(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs)
    pairs, counts = pairs[order], counts[order]
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    at = np.flatnonzero(new)
    return pairs[at], np.add.reduceat(counts, at) if len(at) else counts


def _pair_counter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs and how many links hold them; a task adds up until GROUP_PAIRS distinct ones are met."""

    def batch(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    met, n = np.empty(0, np.int64), np.empty(0, np.int64)
    for _, _, pairs, times in _pair_groups(batches):
        met, n = _added_up(np.concatenate([met, pairs]), np.concatenate([n, times]))
        if len(met) >= GROUP_PAIRS:
            yield batch(met, n)
            met, n = met[:0], n[:0]
    if len(met):
        yield batch(met, n)


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """pair (id of A * b_size + id of B), n, best: links that hold it; the most for its id of B."""
    counts = written(
        aligned.select("pairs", "times")
        .mapInArrow(_pair_counter, "pair bigint, n bigint")
        .groupBy("pair")
        .agg(F.sum("n").alias("n")),
        "pair_counts",
    )
    # A row for each id of B at most, that is, for each entry of its vocabulary.
    most = counts.groupBy((F.col("pair") % b_size).alias("b_id")).agg(F.max("n").alias("most"))
    both = counts.withColumn("b_id", F.col("pair") % b_size).join(F.broadcast(most), "b_id")
    return written(both.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _scorer(frequent) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = frequent.value
        for rows, sizes, pairs, times in _pair_groups(batches):
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            found = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            n, lead = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            n[found] = counts[at[found]] * times[found]
            lead[found] = best[at[found]] * times[found]
            ends = np.cumsum(sizes)
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (lead, n, ~found)]
            n_best, count_sum, _ = (x[ends] - x[ends - sizes] for x in sums)
            rest = pa.StructArray.from_arrays(
                [pa.array(x[~found]) for x in (pairs, times)], names=["pair", "times"]
            )
            rest_ends = np.concatenate([[0], sums[2][ends]]).astype(np.int32)
            kept = [rows.column(name) for name in ("row", "id", *NUMBERS, "groups_sha256")]
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array(n_best),
                    pa.array(count_sum),
                    pa.ListArray.from_arrays(rest_ends, rest),
                ],
                names=["row", "id", *NUMBERS, "groups_sha256", "n_best", "count_sum", "rest"],
            )

    return run


def alignment_scores(
    df: DataFrame,
    a_path: Path,
    b_path: Path,
    b_size: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    A NULL or empty text, and one that a side does not give back byte by byte, has no tokens: zeros
    and an empty digest. Repeated rows and NULL ids are rows like others, and their links count each
    time. Other columns are left out; an empty table gives an empty table. `b_size` is the number
    of B's ids. A path that is a function is asked for in the task.
    """
    spark = df.sparkSession
    aligned = aligned_table(df, a_path, b_path, id_col, text_col)
    pairs = pair_counts(aligned, b_size)
    top = pairs.orderBy(F.desc("n"), "pair").limit(TOP).toArrow().sort_by("pair")
    frequent = spark.sparkContext.broadcast(
        tuple(top[name].to_numpy(zero_copy_only=False) for name in ("pair", "n", "best"))
    )
    kind = aligned.schema["id"].dataType.simpleString()
    numbers = ", ".join(f"{name} bigint" for name in NUMBERS)
    scored = written(
        aligned.mapInArrow(
            _scorer(frequent),
            f"row bigint, id {kind}, {numbers}, groups_sha256 string, n_best bigint, "
            "count_sum bigint, rest array<struct<pair:bigint,times:int>>",
        ),
        "scores",
    )
    rest = (
        scored.select("row", F.inline("rest"))
        .join(pairs, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times"))).alias("more_best"),
            F.sum(F.col("n") * F.col("times")).alias("more"),
        )
    )
    none = F.lit(0).cast("bigint")
    return scored.join(rest, "row", "left").select(
        F.col("id").alias(id_col),
        *NUMBERS,
        (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", none)).alias("count_sum"),
        "groups_sha256",
    )


def _group_maker(a_path: Path, b_path: Path) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(a_path, b_path)
        for rows, batch in _small_batches(batches, sides):
            columns = []
            ends, starts = [np.cumsum(batch.per_doc(doc)) for doc in batch.doc], []
            starts = [np.concatenate([[0], end[:-1]]) for end in ends]
            closing = batch.closing
            for k in (0, 1):
                last = np.flatnonzero(closing[k])
                begins = np.concatenate([[0], last[:-1] + 1]).astype(np.int32)
                offsets = np.concatenate([begins[: len(last)], [len(batch.ids[k])]])
                ids = pa.array(batch.ids[k].astype(np.int32))
                columns.append(pa.ListArray.from_arrays(offsets.astype(np.int32), ids))
            per_doc = batch.per_doc(batch.doc[0][closing[0]])
            groups = pa.ListArray.from_arrays(
                np.cumsum([0, *per_doc]).astype(np.int32),
                pa.StructArray.from_arrays(columns, names=["a", "b"]),
            )
            a, b = batch.links()
            doc = batch.doc[0][a]
            order = np.lexsort((b, a))
            a, b, doc = a[order], b[order], doc[order]
            links = pa.ListArray.from_arrays(
                np.cumsum([0, *batch.per_doc(doc)]).astype(np.int32),
                pa.StructArray.from_arrays(
                    [
                        pa.array((a - starts[0][doc]).astype(np.int32)),
                        pa.array((b - starts[1][doc]).astype(np.int32)),
                    ],
                    names=["a", "b"],
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), groups, links], names=["id", "groups", "links"]
            )

    return run


def alignments(
    df: DataFrame, a_path: Path, b_path: Path, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, `groups` (ids of A and of B, group by group) and `links` (numbers of tokens that overlap).

    The odd rows are those of `alignment_scores`; without tokens both lists are empty.
    """
    tokens = token_table(df, a_path, b_path, id_col, text_col)
    kind = tokens.schema["id"].dataType.simpleString()
    made = tokens.mapInArrow(
        _group_maker(a_path, b_path),
        f"id {kind}, groups array<struct<a:array<int>,b:array<int>>>, "
        "links array<struct<a:int,b:int>>",
    )
    return made.withColumnRenamed("id", id_col)
