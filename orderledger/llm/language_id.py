"""Language identification by a byte convolutional network, in numpy.

A window of 256 bytes is embedded byte by byte; filters of several widths run over it, the
largest value of each filter is pooled, and a softmax over the pooled values gives the languages.
Every text is cut into windows from its first to its last byte, and a text's probabilities are
the mean of its windows', weighted by their bytes.

The network is trained on the driver on a bounded sample: pieces of PIECE characters from
PIECES places of some ROWS_PER_LANGUAGE documents of each language. Prediction runs in tasks, in
batches of windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderledger.llm.common import text_groups

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Windows that go through the network at once.
BATCH = 64
ROWS_PER_LANGUAGE = 700
PIECES, PIECE = 3, 200
EPOCHS, RATE, TRAIN_BATCH = 6, 0.01, 64
#: A small sample is gone through more often, until the network has made so many steps.
LEAST_STEPS = 300
UNKNOWN = "und"
WORD_CHARACTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is alphabetic; a fraction, say, is a word character and no letter."""
    return any(found[0].isalpha() for found in WORD_CHARACTER.finditer(text))


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    output: np.ndarray
    output_bias: np.ndarray
    training: bool = False

    def arrays(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.output, self.output_bias]

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest value of each filter in each window (at least 0), and where it is."""
        embedded = self.embedding[windows]
        values, places = [], []
        for width, weights, bias in zip(WIDTHS, self.filters, self.biases):
            n, length = len(windows), WINDOW - width + 1
            size = embedded.itemsize
            rows = np.lib.stride_tricks.as_strided(
                embedded,
                (n, length, width * EMBEDDING),
                (WINDOW * EMBEDDING * size, EMBEDDING * size, size),
            )
            found = rows.reshape(n * length, -1) @ weights
            found = found.reshape(n, length, FILTERS)
            places.append(found.argmax(1) if self.training else None)
            values.append(np.maximum(found.max(1) + bias, 0))
        return np.concatenate(values, 1), places

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        scores = pooled @ self.output + self.output_bias
        scores = np.exp(scores - scores.max(1, keepdims=True))
        return scores / scores.sum(1, keepdims=True)

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy; a filter learns from the place of its largest value."""
        pooled, places = self.pooled(windows)
        error = self.probabilities(pooled)
        error[np.arange(len(labels)), labels] -= 1
        error /= len(labels)
        back = (error @ self.output.T) * (pooled > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters, d_biases = [], []
        for k, (width, weights) in enumerate(zip(WIDTHS, self.filters)):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            at = places[k][:, :, None] + np.arange(width)
            chars = windows[np.arange(len(windows))[:, None, None], at]
            seen = self.embedding[chars].reshape(len(windows), FILTERS, -1)
            d_filters.append(np.einsum("nf,nfw->wf", own, seen))
            d_biases.append(own.sum(0))
            d_seen = own[:, :, None] * weights.T[None]
            np.add.at(
                d_embedding,
                chars.reshape(-1),
                d_seen.reshape(-1, EMBEDDING).astype(self.embedding.dtype),
            )
        return [d_embedding, *d_filters, *d_biases, pooled.T @ error, error.sum(0)]


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows, the last of a text filled up with zeros; their text and their bytes."""
    lengths = np.array([len(text) for text in texts], np.int64)
    counts = -(-lengths // WINDOW)
    filled = b"".join(text + bytes(-len(text) % WINDOW) for text in texts)
    windows = np.frombuffer(filled, np.uint8).reshape(-1, WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    last = np.cumsum(counts)[owner] - 1 == np.arange(len(owner))
    return windows, owner, np.where(last, (lengths[owner] - 1) % WINDOW + 1, WINDOW)


def train(texts: list[str], labels: list[str], seed: int = 5) -> Network | None:
    """Adam over the windows of labelled texts; None without any."""
    languages = sorted(set(labels))
    if not languages:
        return None
    random = np.random.default_rng(seed)

    def some(*shape: int) -> np.ndarray:
        return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    network = Network(
        languages,
        some(256, EMBEDDING) * 8,
        [some(width * EMBEDDING, FILTERS) for width in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        some(len(WIDTHS) * FILTERS, len(languages)),
        np.zeros(len(languages), np.float32),
        training=True,
    )
    windows, owner, _ = windows_of([text.encode() for text in texts])
    known = np.searchsorted(languages, labels)[owner]
    weights = network.arrays()
    means = [np.zeros_like(w) for w in weights]
    squares = [np.zeros_like(w) for w in weights]
    epochs, step = max(EPOCHS, -(-LEAST_STEPS * TRAIN_BATCH // len(windows))), 0
    for epoch in range(epochs):
        order = random.permutation(len(windows))
        rate = RATE * (1 - epoch / epochs)
        for begin in range(0, len(order), TRAIN_BATCH):
            batch = order[begin : begin + TRAIN_BATCH]
            step += 1
            for w, m, s, g in zip(
                weights, means, squares, network.gradients(windows[batch], known[batch])
            ):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-7)
    network.training = False
    return network


def predict(network: Network | None, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and its probability; `und` and 0 for a text without a letter."""
    spoken = [network is not None and has_letter(text) for text in texts]
    found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows = np.flatnonzero(spoken)
    if len(rows):
        windows, owner, sizes = windows_of([texts[row].encode() for row in rows])
        total = np.zeros((len(rows), len(network.languages)))
        for begin in range(0, len(windows), BATCH):
            part = slice(begin, begin + BATCH)
            likely = network.probabilities(network.pooled(windows[part])[0])
            np.add.at(total, owner[part], likely * sizes[part, None])
        total /= total.sum(1, keepdims=True)
        best = total.argmax(1)
        scores[rows] = total[np.arange(len(rows)), best]
        for row, language in zip(rows, best):
            found[row] = network.languages[language]
    return found, scores


def training_sample(labelled: DataFrame) -> tuple[list[str], list[str]]:
    """Pieces of documents (id, text, lang), of each language some ROWS_PER_LANGUAGE by a hash.

    Every document of a language has the same chance; what comes to the driver is bounded by the
    number of languages, not by the documents or their lengths.
    """
    known = labelled.filter(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").rlike("\\p{L}")
    )
    counts = known.groupBy("lang").count().collect()
    pieces = [
        F.substring("text", 1 + F.floor(F.length("text") * k / PIECES).cast("int"), F.lit(PIECE))
        for k in range(PIECES)
    ]
    chance = F.lit(0.0)
    for row in counts:
        chance = F.when(F.col("lang") == row.lang, ROWS_PER_LANGUAGE / row["count"]).otherwise(
            chance
        )
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < chance * (1 << 30)
    rows = known.filter(drawn).select("id", "lang", F.array(*pieces).alias("pieces")).collect()
    rows.sort(key=lambda row: (row.id, row.pieces))
    usable = [(piece, row.lang) for row in rows for piece in row.pieces if has_letter(piece)]
    return [piece for piece, _ in usable], [lang for _, lang in usable]


def held_out(id_column: Column) -> Column:
    """One document in five, by the checksum of its id; false without an id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _predictor(network: Network | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            found, scores = predict(network, texts)
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(found, pa.string()), pa.array(scores)],
                names=["row", "lang_pred", "score"],
            )

    return run


def predicted(
    df: DataFrame,
    carried: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """`row` (the carried columns), lang_pred and score (0 to 1) for every row.

    Learns from rows with an id and a language that are not held out; a prediction sees the text
    alone. A NULL text or one without a letter is `und` with score 0, and so is every text if
    there is nothing to learn from. Repeated rows and NULL ids are rows like others; columns ride
    along in `row` whatever their names; an empty table gives an empty table.
    """
    labelled = df.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    network = train(*training_sample(labelled.filter(~held_out(F.col("id")))))
    rows = df.select(
        F.struct(*(F.col(f"`{name}`") for name in carried)).alias("row"),
        F.col(text_col).alias("text"),
    )
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_predictor(network), f"row {kind}, lang_pred string, score double")


def identify(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Id, held_out, lang_pred and score of every row; see `predicted`."""
    key = F.col(f"row.{id_col}")
    return predicted(df, [id_col], id_col, text_col, lang_col).select(
        key.alias(id_col), held_out(key).alias("held_out"), "lang_pred", "score"
    )
