"""Column types of text tables, found in one pass.

A cell fits the types of a lattice: missing below all, text above all, and in between boolean,
integer under decimal under double, and timestamps by pattern. What each column's cells fit is
counted, and the digits that its numbers need are kept as maxima: sums and maxima, which tasks
combine before anything is shuffled, one row a task. From these a column's type is the lowest that
enough of its cells fit; of timestamp patterns the one with the most votes, the first listed in a tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import missing_if_token

BOOLEAN = r"(?i)\A(true|false)\z"
INTEGER = r"\A\s*[+-]?[0-9]+\s*\z"
DECIMAL = r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*\z"
DOUBLE = r"(?i)\A\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?)\s*\z"
#: The precision of the widest decimal, and of a number that always fits BIGINT.
WIDEST, LONG = 38, 18

#: Datetime patterns: the form of a cell, and how its parts make up an ISO timestamp.
_TIME = "( [0-9]{2}:[0-9]{2}:[0-9]{2})"
PATTERNS = {
    "yyyy-MM-dd HH:mm:ss": (rf"\A([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}){_TIME}\z", "$1$2"),
    "yyyy-MM-dd": (r"\A([0-9]{4}-[0-9]{2}-[0-9]{2})\z", "$1 00:00:00"),
    "yyyy-MM-dd'T'HH:mm:ss": (
        r"\A([0-9]{4}-[0-9]{2}-[0-9]{2})T([0-9]{2}:[0-9]{2}:[0-9]{2})\z",
        "$1 $2",
    ),
    "MM/dd/yyyy HH:mm:ss": (rf"\A([0-9]{{2}})/([0-9]{{2}})/([0-9]{{4}}){_TIME}\z", "$3-$1-$2$4"),
    "dd/MM/yyyy HH:mm:ss": (rf"\A([0-9]{{2}})/([0-9]{{2}})/([0-9]{{4}}){_TIME}\z", "$3-$2-$1$4"),
}


def timestamp_by(pattern: str, text: Column) -> Column:
    """The zone-free timestamp of a cell that has the pattern, else NULL."""
    form, iso = PATTERNS[pattern]
    made = F.regexp_replace(text, form, iso).try_cast("timestamp_ntz")
    return F.when(text.rlike(form), made)


#: What a cell is taken for: one of these, or of these and the timestamps' patterns.
MISSING, BOOLEANS, INTEGERS, DECIMALS, DOUBLES, TEXT, EITHER_SLASHED, TIMESTAMPS = range(8)
SPACES = " \t\n\x0b\f\r"


def _timestamp_kind(cell: Column) -> list[tuple[Column, Column]]:
    """Conditions on a cell that has a timestamp's form, and its kind then.

    The cell's bytes and a separator leave one expression to try at most, and none for most cells.
    """
    place = {name: TIMESTAMPS + k for k, name in enumerate(PATTERNS)}
    month_first, day_first = "MM/dd/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss"

    def has(name: str, size: int, at: int, separator: str) -> Column:
        there = (F.octet_length(cell) == size) & (F.substring(cell, at, 1) == separator)
        return there & cell.rlike(PATTERNS[name][0])

    def slashed(month: int, day: int) -> Column:
        parts = [(7, 4), (month, 2), (day, 2)]
        date = F.concat_ws("-", *(F.substring(cell, *part) for part in parts))
        return F.concat(date, F.substring(cell, 11, 9)).try_cast("timestamp_ntz").isNotNull()

    kinds = [
        (
            has(name, *form),
            F.when(cell.try_cast("timestamp_ntz").isNotNull(), place[name]).otherwise(TEXT),
        )
        for name, form in {
            "yyyy-MM-dd HH:mm:ss": (19, 11, " "),
            "yyyy-MM-dd": (10, 5, "-"),
            "yyyy-MM-dd'T'HH:mm:ss": (19, 11, "T"),
        }.items()
    ]
    either = (
        F.when(slashed(1, 4), F.when(slashed(4, 1), EITHER_SLASHED).otherwise(place[month_first]))
        .when(slashed(4, 1), place[day_first])
        .otherwise(TEXT)
    )
    return [*kinds, (has(month_first, 19, 3, "/"), either)]


def _kind(cell: Column) -> Column:
    """The one kind of a cell: the lowest of the lattice, or a timestamp's pattern."""
    whole = F.when(F.instr(cell, ".") == 0, INTEGERS).otherwise(DECIMALS)
    kind = F.when(cell.isNull(), MISSING)
    for condition, found in _timestamp_kind(cell):
        kind = kind.when(condition, found)
    return (
        kind.when(cell.rlike(DECIMAL), whole)
        .when(F.octet_length(cell).between(4, 5) & cell.rlike(BOOLEAN), BOOLEANS)
        .when(cell.rlike(DOUBLE), DOUBLES)
        .otherwise(TEXT)
    )


def _votes(cell: Column) -> Column:
    """What the cells of a column fit, as one struct of sums and maxima.

    Each cell is given its kind once, by one or two expressions, and the kinds are counted. Spark
    makes the kind, which the aggregates share, a function of its own for each column.
    """
    kind = _kind(cell)
    number = kind.isin(INTEGERS, DECIMALS)
    digits = F.btrim(cell, F.lit(f"{SPACES}+-"))
    whole = F.substring_index(digits, ".", 1)
    before = F.length(F.ltrim(whole, F.lit("0")))
    after = F.greatest(F.length(digits) - F.length(whole) - 1, F.lit(0))

    def count(*kinds: int) -> Column:
        return F.count_if(kind.isin(*kinds) if len(kinds) > 1 else kind == kinds[0])

    slashed = [k for k, name in enumerate(PATTERNS) if "/" in name]
    return F.struct(
        F.count("*").alias("rows"),
        count(MISSING).alias("missing"),
        count(BOOLEANS).alias("booleans"),
        count(INTEGERS).alias("integers"),
        count(INTEGERS, DECIMALS).alias("decimals"),
        count(INTEGERS, DECIMALS, DOUBLES).alias("doubles"),
        F.coalesce(F.max(F.when(number, before)), F.lit(0)).alias("before"),
        F.coalesce(F.max(F.when(number, after)), F.lit(0)).alias("after"),
        F.array(
            *(
                count(TIMESTAMPS + k, EITHER_SLASHED) if k in slashed else count(TIMESTAMPS + k)
                for k in range(len(PATTERNS))
            )
        ).alias("patterns"),
    )


def _counted(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the votes on each column, `_0` on the first."""
    cells = df.select(*(missing_if_token(F.col(f"`{n}`")).alias(f"_{k}") for k, n in enumerate(columns)))
    return cells.agg(*(_votes(F.col(f"_{k}")).alias(f"_{k}") for k in range(len(columns))))


def infer_column_types(df: DataFrame, least_percent: int = 100) -> DataFrame:
    """One row per text column: what it holds, and the lowest type that enough of its cells fit.

    Columns: column_name, row_count, missing_count, inferred_type, pattern (of timestamps),
    fitting_count. Enough is `least_percent` of the cells that are not missing; the others are NULL
    once they are cast. A column of missing cells only has the type "void"; digits beyond the widest
    decimal make a double.
    """
    columns = [name for name, kind in df.dtypes if kind == "string"]
    counted = _counted(df, columns)
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("column_name"), F.col(f"_{k}").alias("votes"))
            for k, name in enumerate(columns)
        )
    )
    found = counted.select(F.inline(rows)).select("column_name", "votes.*")
    present = F.col("rows") - F.col("missing")
    most = F.array_max("patterns")
    width = F.greatest(F.col("before") + F.col("after"), F.lit(1))

    def enough(count: Column) -> Column:
        return count * 100 >= present * least_percent

    def decimal(scale: Column, digits: Column) -> Column:
        named = F.concat(F.lit("decimal("), digits, F.lit(","), scale, F.lit(")"))
        return F.when(digits <= WIDEST, named).otherwise("double")

    integer = F.when(F.col("before") <= LONG, "bigint").otherwise(
        decimal(F.lit(0), F.greatest(F.col("before"), F.lit(1)))
    )
    kinds = [
        (F.col("booleans"), F.lit("boolean")),
        (F.col("integers"), integer),
        (F.col("decimals"), decimal(F.col("after"), width)),
        (F.col("doubles"), F.lit("double")),
        (most, F.lit("timestamp_ntz")),
    ]
    kind, fitting = F.when(present == 0, "void"), F.when(present == 0, F.lit(0).cast("bigint"))
    for count, name in kinds:
        kind, fitting = kind.when(enough(count), name), fitting.when(enough(count), count)
    names = F.array(*map(F.lit, PATTERNS))
    pattern = F.get(names, (F.array_position("patterns", most) - 1).cast("int"))
    return found.select(
        "column_name",
        F.col("rows").alias("row_count"),
        F.col("missing").alias("missing_count"),
        kind.otherwise("string").alias("inferred_type"),
        pattern.alias("pattern"),
        fitting.otherwise(present).alias("fitting_count"),
    ).withColumn("pattern", F.when(F.col("inferred_type") == "timestamp_ntz", F.col("pattern")))


def cast_columns(df: DataFrame, types: list[Row]) -> DataFrame:
    """The text columns as the types found for them; cells that do not fit become NULL."""

    def typed(row: Row) -> Column:
        cell = missing_if_token(F.col(f"`{row.column_name}`"))
        if row.pattern is not None:
            return timestamp_by(row.pattern, cell)
        if row.inferred_type in ("string", "void"):
            return cell
        form = {"boolean": BOOLEAN, "bigint": INTEGER, "double": DOUBLE}.get(
            row.inferred_type, DECIMAL
        )
        return F.when(cell.rlike(form), F.trim(cell).try_cast(row.inferred_type))

    return df.withColumns({row.column_name: typed(row) for row in types})
