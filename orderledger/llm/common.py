"""What the operators of this folder share: words, tables on disk, bounded batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderledger.sources import runs

#: A word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here.

    A lost executor costs the tasks it ran, never the steps before the table.
    """
    spark = df.sparkSession
    path = runs.new_path(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def text_groups(
    batches: Iterable[pa.RecordBatch], most: int = 2_000_000
) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts (first and second column, NULL texts empty) of bounded size.

    A group ends once its texts reach `most` characters, so that what a task makes of it
    stays bounded whatever the length of a batch; one longer text is a group of its own.
    """
    for batch in batches:
        begin, texts, size = 0, [], 0
        for text in batch.column(1):
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= most:
                yield batch.column(0).slice(begin, len(texts)), texts
                begin, texts, size = begin + len(texts), [], 0
        if texts:
            yield batch.column(0).slice(begin, len(texts)), texts
