"""Mixing sources to target weights by systematic sampling.

Every document has an expected number of copies. Within its source the expected copies are
summed up in a fixed order, one random offset is added, and a document is emitted once for each
whole number that its stretch of the sum crosses. So a document gets its expectation rounded up
or down, and a source as many copies as it expects, give or take one. The order goes by size,
so that the sample takes small and large documents in proportion.

No source is gathered in one task. The order is (size band, hash block, size, id): the sums over
bands, then over the blocks of a band, then within a block are three steps, and only a block's
documents meet in a task: of a hot source, 1/256 of a band.

Expected copies are whole numbers of millionths, so the sums are exact and do not depend on how
rows are dealt out: a rerun on any cluster takes the same documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNIT = 1_000_000
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = 17


def source_targets(sizes: DataFrame, weights=WEIGHTS, most=MOST_COPIES) -> DataFrame:
    """source, source_size, target: weight shares of the whole, none above `most` times its size.

    `sizes` has source and source_size, a row per source. In code-point order, NULL last, sources
    weigh `weights` in turn. A target is the smaller of cap and level times weight; the level is
    the largest of those found by taking the sources with the lowest cap per weight as capped,
    for each number of them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = sizes.select(
        "source",
        "source_size",
        F.get(F.array(*map(F.lit, weights)), turn).alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    )
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    onwards = by_cap.rowsBetween(0, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levels = ranked.withColumn("level", left / F.sum("weight").over(onwards))
    target = F.least(
        F.col("cap").cast("double"), F.max("level").over(every) * F.col("weight")
    )
    return levels.select("source", "source_size", target.alias("target"))


def _digest(seed: int, key: Column, digits: int) -> Column:
    """A number from the first hexadecimal digits of a digest; NULL counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def _band(size: Column) -> Column:
    """Four bands for each doubling of the size: its number of bits and its three highest."""
    bits = F.bin(size)
    return F.length(bits) * 8 + F.conv(F.substring(bits, 1, 3), 2, 10).cast("int")


def systematic_sample(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds `copies` to rows with id, source, size and `units` (expected copies in millionths).

    Rows that agree in source, size and id are told apart by nothing and take turns.
    """
    # A key without NULLs, by which rows are dealt out once for both the window and the join.
    named = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("none"))
    place = ["source_key", "band", "block"]
    dealt = rows.withColumns(
        {
            "source_key": named,
            "band": _band(F.col("size")),
            "block": _digest(seed, F.col("id"), 2),
            "offset": _digest(seed, F.col("source"), 8) % UNIT,
        }
    )
    blocks = dealt.groupBy(place).agg(F.sum("units").alias("block_units"))
    bands = blocks.groupBy(place[:2]).agg(F.sum("block_units").alias("band_units"))
    earlier = (Window.unboundedPreceding, -1)
    bands_before = F.sum("band_units").over(
        Window.partitionBy("source_key").orderBy("band").rowsBetween(*earlier)
    )
    blocks_before = F.sum("block_units").over(
        Window.partitionBy("source_key", "band").orderBy("block").rowsBetween(*earlier)
    )
    bands = bands.select(*place[:2], F.coalesce(bands_before, F.lit(0)).alias("bands_before"))
    blocks = blocks.withColumn("blocks_before", F.coalesce(blocks_before, F.lit(0)))
    before = (F.col("bands_before") + F.col("blocks_before")).alias("before")
    starts = blocks.join(bands, place[:2]).select(*place, before)
    in_block = Window.partitionBy(place).orderBy("size", "id")
    upto = F.sum("units").over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    until = "offset + before + upto"
    copies = F.expr(f"({until}) div {UNIT} - ({until} - units) div {UNIT}")
    summed = dealt.withColumn("upto", upto).join(starts, place)
    return summed.withColumn("copies", copies).drop(*place, "offset", "before", "upto")


def mix(
    df: DataFrame,
    size: Column,
    source_col: str = "source",
    id_col: str = "doc_id",
    weights=WEIGHTS,
    seed: int = SEED,
) -> DataFrame:
    """`row` (the whole input row), size, source_size, target and copies, for every row.

    A NULL size counts as 0, a NULL source is a source of its own. Repeated rows are rows like
    others. Copies are at most 3. A source without words has target 0 and its rows no copies;
    an empty table gives an empty table. Extra columns ride along in `row`, whatever their names.
    """
    rows = df.select(
        F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("row"),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.coalesce(size.cast("bigint"), F.lit(0)).alias("size"),
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights).withColumnRenamed("source", "s")
    units = F.when(
        F.col("source_size") > 0, F.round(F.col("target") * UNIT / F.col("source_size"))
    ).otherwise(0)
    expected = rows.join(targets, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "units", units.cast("bigint")
    )
    sampled = systematic_sample(expected.drop("s"), seed)
    return sampled.select("row", "size", "source_size", "target", "copies")


def emit(mixed: DataFrame) -> DataFrame:
    """The rows of the mix, each as often as it was taken."""
    return mixed.select("row", F.explode(F.expr("array_repeat(0, int(copies))"))).select("row.*")
