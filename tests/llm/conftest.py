import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with columns whose names operators use themselves."""

    def make(rows, **columns):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        clashes = ["id", "row", "n", "kept", "name", "size", "task", "target", "lines"]
        extra = {name: F.lit("mine") for name in clashes} | columns
        return df.withColumns(extra)

    return make


#: Cases that every operator on documents meets.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (None, "no id, a text of some words"),
    (5, "the same words over and over " * 4000),
    (6, "tie"),
    (7, "tie"),
    (7, "tie"),
]
