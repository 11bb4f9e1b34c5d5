from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import NULL_TOKENS


def missing_if_token(text: Column) -> Column:
    """NULL where the cell is one of the missing-value tokens, else the cell."""
    return F.when(~text.isin(NULL_TOKENS), text)
