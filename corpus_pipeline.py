"""Training text from the documents: five stages, each written and read again by the next.

Each stage works on all rows that the one before it kept, and what it decides takes effect:
rejected documents and repeated lines are gone, one document of each near-duplicate group stays,
and documents are repeated or left out as the mix takes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderledger.llm import language_id, line_dedup, mixing, near_duplicates, sentencepiece_codec
from orderledger.llm.common import table, words_of, written
from orderledger.llm.queries import piece_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rejected are documents without a letter, and those whose language is a guess. Of 0.4, 0.5, 0.55,
#: 0.6, 0.65 and 0.7 the largest that keeps 99.5 % of the held-out documents at each given size.
LEAST_SCORE = 0.65


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is told from their text with a score of LEAST_SCORE or more.

    NULL and empty texts, and texts without a letter, have no language and go. Repeated rows and
    rows without an id are rows like others; an empty table gives an empty one.
    """
    found = language_id.predicted(docs, COLUMNS)
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.filter(sure).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that come earlier, n_chars counted again.

    Documents that lose all their words go; those that lose nothing stay as they are, also with NULL
    or empty texts. Rows without an id keep their lines; rows that repeat id and text lose the same.
    """
    left = line_dedup.dedup_lines(docs.select(COLUMNS))
    return left.select("row.*", "kept_text").withColumns(
        {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    ).select(COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Texts without a word and rows without an id are in no group and stay; rows that repeat id and
    text are one document.
    """
    return near_duplicates.one_of_each(docs.select(COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three times, its size its words.

    A NULL source is a source like others; texts without a word have size 0 and are drawn too.
    """
    size = F.size(words_of(F.col("text")))
    return mixing.emit(mixing.mix(docs.select(COLUMNS), size))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of tokens of every row, and digests of its ids and of the text they decode to.

    A NULL text counts as empty; repeated rows and rows without an id are rows like others.
    """
    return sentencepiece_codec.encoded_digests(docs, piece_model)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_duplicates", near),
    ("mixing", mix),
    ("sentencepiece", tokens),
]

#: No SQL: a trained network decides in the first stage. tests/llm holds each stage against a
#: plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns, over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
