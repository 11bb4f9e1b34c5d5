"""SentencePiece encoding and decoding by a table of distinct marked words.

A text is marked as the library marks it: one marker in front, each space a marker. No piece
of the vocabulary has a marker after another character, so no merge ever crosses from a word
into the marker of the next one, and each marked word (its markers and the characters up to
the next marker) is segmented on its own. A task keeps a table of the distinct marked words it
has met, segments each of them once, and joins the ids back by position.

The table belongs to a task and has a bounded number of entries: a table over the whole
corpus would have to be joined to every word by position, which shuffles far more bytes than
the texts have (README).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import text_groups

#: The white-space marker, a fixed value of the library.
MARK = "▁"
MARKED_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Words a task keeps, and ids of them; at some 200 bytes a word the table stays near 50 MB.
TABLE_ENTRIES, TABLE_IDS = 1 << 18, 1 << 22
#: Longer words are segmented where they stand and not kept.
KEPT_CHARS = 64
#: Characters of the texts that a task works on at once, and of a part of a longer text.
GROUP_CHARS = 250_000


def text_parts(text: str, most: int = GROUP_CHARS) -> list[str]:
    """A text cut at spaces into parts of some `most` characters.

    A cut is where a run of markers begins, so that no word is cut: a part but for the first
    begins with the marker of its first word.
    """
    parts, begin = [], 0
    while len(text) - begin > most:
        at = begin + most
        while (at := text.find(" ", at)) >= 0 and text[at - 1] in (" ", MARK):
            at += 1
        if at < 0:
            break
        parts.append(text[begin:at])
        begin = at
    parts.append(text[begin:])
    return parts


def marked_words(text: str, first: bool = True) -> list[str]:
    """The text cut before each run of markers; an empty text has no words.

    A `first` part of a text gets the marker in front, a later one begins with its own.
    """
    if not text:
        return []
    marked = (MARK if first else "") + text.replace(" ", MARK)
    if MARK + MARK in marked:
        return MARKED_WORD.findall(marked)
    return marked.replace(MARK, " " + MARK).split(" ")[1:]


class ChunkTable:
    """The ids of distinct marked words, each segmented by the library once.

    Kept words fill the front of two arrays that grow by doubling. Words too long to be kept stand
    behind them for the texts at hand and are gone with these, ids and all.
    """

    def __init__(self, model_path: str, entries: int = TABLE_ENTRIES, most_ids: int = TABLE_IDS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("this vocabulary has pieces that cross whitespace markers")
        self.entries, self.most_ids = entries, most_ids
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.n_words = self.n_ids = 0
        #: The ids of row k are those from ends[k] to ends[k + 1].
        self.ends = np.zeros(1024, np.int64)
        self.ids = np.empty(4096, np.int32)

    def segment(self, words: list[str]) -> list[list[int]]:
        """The library puts a marker in front itself, so a word goes in without its first."""
        mark = [self.model.piece_to_id(MARK)]
        found = self.model.encode([word[1:] for word in words], num_threads=1)
        return [ids if len(word) > 1 else mark for word, ids in zip(words, found)]

    def add(self, words: list[str]) -> None:
        """New rows behind the ones there."""
        found = self.segment(words)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        first, last = self.n_words, self.n_words + len(words)
        n_ids = self.n_ids + int(lengths.sum())
        self.ends = _room(self.ends, first + 1, last + 1)
        self.ids = _room(self.ids, self.n_ids, n_ids)
        self.ends[first + 1 : last + 1] = self.n_ids + np.cumsum(lengths)
        self.ids[self.n_ids : n_ids] = np.fromiter(
            chain.from_iterable(found), np.int32, n_ids - self.n_ids
        )
        self.rows.update(zip(words, range(first, last)))
        self.n_words, self.n_ids = last, n_ids

    def forget(self, words: list[str], n_words: int, n_ids: int) -> None:
        """Take out the last rows, down to the numbers that were there before them."""
        for word in words:
            del self.rows[word]
        self.n_words, self.n_ids = n_words, n_ids
        if len(self.ids) > 4 * self.most_ids:
            self.ids = self.ids[: self.most_ids + n_ids].copy()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text: the rows of its words, one behind the other."""
        parts = [text_parts(text) for text in texts]
        found, group, size = [], [], 0
        for k, part in ((k, part) for text in parts for k, part in enumerate(text)):
            group.append((part, k == 0))
            size += len(part)
            if size >= GROUP_CHARS:
                found.extend(self._encode_group(group))
                group, size = [], 0
        found.extend(self._encode_group(group))
        ends = np.cumsum([0, *map(len, parts)])
        return [
            found[a] if b - a == 1 else np.concatenate(found[a:b])
            for a, b in zip(ends[:-1], ends[1:])
        ]

    def _encode_group(self, parts: list[tuple[str, bool]]) -> list[np.ndarray]:
        words = [marked_words(text, first) for text, first in parts]
        distinct = set(chain.from_iterable(words))
        new = distinct.difference(self.rows)
        if len(self.rows) + len(new) > self.entries or self.n_ids > self.most_ids:
            self.clear()
            new = distinct
        self.add([word for word in new if len(word) <= KEPT_CHARS])
        long, kept = [word for word in new if len(word) > KEPT_CHARS], (self.n_words, self.n_ids)
        self.add(long)
        rows = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(words)), np.int64)
        starts, lengths = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        ends = np.cumsum(lengths)
        places = np.repeat(starts - ends + lengths, lengths) + np.arange(lengths.sum())
        ids = self.ids[places]
        self.forget(long, *kept)
        text_ends = np.cumsum([0, *map(len, words)])
        cuts = np.concatenate([[0], ends])[text_ends]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def decode(self, ids: np.ndarray) -> str:
        return self.model.decode(ids.tolist())


def _room(array: np.ndarray, used: int, needed: int) -> np.ndarray:
    """The array, or one twice as long or longer with what is used of it."""
    if needed <= len(array):
        return array
    larger = np.empty(max(needed, 2 * len(array)), array.dtype)
    larger[:used] = array[:used]
    return larger


def encode_decode(
    df: DataFrame,
    model_path: str | Callable[[], str],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id, `ids` (array of int) and `decoded` of every row; other columns are left out.

    A NULL or empty text has no ids and decodes to an empty text. Repeated rows and NULL ids
    are rows like others. Nothing is shuffled; an empty table gives an empty table. A path that is
    a function is asked for in the task, on the executor that reads it.
    """
    return _coded(df, model_path, id_col, text_col, "ids array<int>, decoded string", _real)


def encoded_digests(
    df: DataFrame,
    model_path: str | Callable[[], str],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id, `n_tokens`, `ids_sha256` and `decoded_sha256` of what `encode_decode` returns.

    The ids (decimal, joined by commas) and the decoded text are hashed where they are made, so
    that neither travels from the worker.
    """
    out = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _coded(df, model_path, id_col, text_col, out, _digests)


def _coded(df, model_path, id_col: str, text_col: str, out: str, columns: Callable) -> DataFrame:
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    found = docs.mapInArrow(_encoder(model_path, columns), f"id {kind}, {out}")
    return found.withColumnRenamed("id", id_col)


def _real(ids: list[np.ndarray], decode: Callable) -> dict[str, pa.Array]:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return {
        "ids": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))),
        "decoded": pa.array([decode(found) for found in ids], pa.string()),
    }


def _digests(ids: list[np.ndarray], decode: Callable) -> dict[str, pa.Array]:
    def sha256(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    return {
        "n_tokens": pa.array([len(found) for found in ids], pa.int64()),
        "ids_sha256": pa.array(
            [sha256(",".join(map(str, found.tolist()))) for found in ids], pa.string()
        ),
        "decoded_sha256": pa.array([sha256(decode(found)) for found in ids], pa.string()),
    }


def _encoder(model_path: str | Callable[[], str], columns: Callable) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model_path() if callable(model_path) else model_path)
        for keys, texts in text_groups(batches, GROUP_CHARS):
            made = columns(table.encode(texts), table.decode)
            yield pa.RecordBatch.from_arrays([keys, *made.values()], names=["id", *made])

    return run
