"""Sharding by balanced label propagation: linked rows move together, shards stay even.

Rows are linked if they agree in all link columns. The members of a group that lie in one shard have
the same neighbours and can stand for each other, so what the rounds move are units: a group is a
row that lists, for each shard that has some, its number of members there. That adds rows up ahead of
every shuffle, and a group's list is no longer than there are shards, however many rows it has.

1. All linked rows are dealt out in turn, so that no shard has more of them than its final size.
2. In each round every unit would move to the shard where most of its group is, of those that have
   room. For two shards, as many rows move one way as the other; beyond that a shard takes what its
   room allows, shared among the shards that send. These quotas are filled in the order of what
   is gained, the last ones by a part of each unit; rows that rounding leaves beyond a shard's size
   (two flows of a swap may differ by a few) are dealt out with the rows of step 4. No move adds to the cut edges, and each that
   happens takes some away: a group's uncut pairs grow with the squares of its units.
   What the units wish for is added up by the two shards, gain and a hash; from these sums, of a
   number that does not grow with the rows, follow the quotas and where each is used up, and the
   groups are joined with these.
3. Once nothing moves to shards with room, shards without it are asked for swaps; when these bring
   nothing either, the units have come to rest. Groups that lie in one shard leave the rounds.
4. Rows without links fill the shards up to their exact sizes.

Row numbers are sums over blocks of rows and then inside a block (`prefix_sums`): neither a shard
nor a group is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderledger.llm.common import written

SHARDS = 24
#: Rounds at most; a group with more rows than a shard takes fills about one shard in a round.
ROUNDS = 40
#: Rows of a block on average, as long as there are no more than MOST_BLOCKS of them.
BLOCK_ROWS, MOST_BLOCKS = 1000, 1 << 16
#: Wishes from a shard to another are told apart by gain and so many hash values.
BUCKETS = 64
#: Rows for each task that writes groups; these are at most half as many.
TASK_ROWS = 500_000
GROUP = ["g1", "g2"]


def prefix_sums(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str,
    blocks: int,
    first: Column | None = None,
) -> DataFrame:
    """Adds `name`, the sum of `value` over the rows of the same keys that come earlier, and `all`.

    `all` is the sum over the keys' rows. `order` tells rows of the same keys apart. They come by
    `first`, if it is given, then by a block that a hash of `order` deals them to, then by `order`.
    Blocks are summed ahead of the shuffle and their sums added up key by key; a window takes only
    the rows that have key, `first` and block in common.
    """
    place = [*keys, "_first", "_block"]
    placed = df.withColumns(
        {
            "_first": F.lit(0) if first is None else first,
            "_block": F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"),
        }
    )
    every = Window.partitionBy(keys)
    earlier = every.orderBy("_first", "_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(place).agg(F.sum(value).alias("_sum"))
    starts = sums.select(
        *place,
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_sum").over(every).alias("all"),
    )
    upto = Window.partitionBy(place).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("_start") + F.sum(value).over(upto) - F.col(value)
    return placed.join(starts, place).withColumn(name, before).drop("_first", "_block", "_start")


def _array(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{value}L' for value in values)})")


def _numbers(values: list[int], index: Column) -> Column:
    return F.get(_array(values), index)


def _dealt_in_turn(groups: DataFrame, shards: int, blocks: int) -> DataFrame:
    """g1, g2, units: the members of all groups, one behind the other, to the shards in turn."""
    dealt = prefix_sums(groups, [], GROUP, "members", "start", blocks)
    units = F.transform(
        F.expr(f"sequence(0L, least({shards}L, members) - 1)"),
        lambda turn: _unit(
            F.call_function("div", F.col("members") - 1 - turn, F.lit(shards)) + 1,
            ((F.col("start") + turn) % shards).cast("int"),
        ),
    )
    return dealt.select(*GROUP, units.alias("units"))


def _unit(n: Column, shard: Column) -> Column:
    """Units compare by their size, then by a hash that prefers another shard for each group."""
    return F.struct(n.alias("n"), F.xxhash64(*GROUP, shard).alias("tie"), shard.alias("shard"))


def _with_goals(groups: DataFrame, room: list[int], swaps: bool) -> DataFrame:
    """Adds `goal`: the largest unit in a shard that has room, or for swaps in any."""
    asked = F.lit(swaps)
    open_units = F.filter("units", lambda unit: asked | (_numbers(room, unit["shard"]) > 0))
    return groups.withColumn("goal", F.array_max(open_units)).withColumn(
        "to", F.col("goal")["shard"]
    )


def _wish_key(shard: Column, number: int) -> Column:
    """The place of a wish among those between two shards: large gains first, then a hash."""
    gain = F.lit(64) - F.length(F.bin(F.col("goal")["n"]))
    bucket = F.pmod(F.xxhash64(*GROUP, shard, F.lit(number)), F.lit(BUCKETS))
    return (gain * BUCKETS + bucket).cast("int")


def _quotas(aimed: DataFrame, room: list[int], number: int) -> DataFrame:
    """to, cuts: for each shard that sends, the first wish that is not met in full.

    A cut is the wish's key, what is left for it and what it asks for; where all is met, none.
    The wishes are added up first: at most 64 * BUCKETS sums for two shards, which one task turns
    into quotas.
    """
    smaller = F.filter("units", lambda unit: unit < F.col("goal"))
    wishes = aimed.select("to", "goal", *GROUP, F.explode(smaller).alias("unit"))
    shard, into = F.col("unit")["shard"].alias("shard"), Window.partitionBy("to")
    sums = (
        wishes.groupBy(shard, "to", _wish_key(shard, number).alias("key"))
        .agg(F.sum("unit.n").alias("wish"))
        .coalesce(1)
    )
    flow = Window.partitionBy("shard", "to")
    pair = Window.partitionBy(F.least("shard", "to"), F.greatest("shard", "to"))
    upto_here = (Window.unboundedPreceding, 0)
    forth = F.sum(F.when(F.expr("shard < to"), F.col("wish"))).over(pair)
    back = F.sum(F.when(F.expr("shard > to"), F.col("wish"))).over(pair)
    swap = F.coalesce(F.when(forth < back, forth).otherwise(F.when(back <= forth, back)), F.lit(0))
    once = F.when(F.col("first"), F.col("rest"))
    rest = (
        sums.withColumns(
            {
                "first": F.row_number().over(flow.orderBy("key")) == 1,
                "upto": F.sum("wish").over(flow.orderBy("key").rowsBetween(*upto_here)),
                "swap": swap,
                "rest": F.sum("wish").over(flow) - swap,
            }
        ).withColumns(
            {
                "all_rest": F.sum(once).over(into),
                "upto_rest": F.sum(once).over(into.orderBy("shard", "key").rowsBetween(*upto_here)),
                "room": _numbers(room, F.col("to")),
            }
        )
    )
    # Shares are differences of rounded sums, so that they use up the room.
    rounded = "CAST({} AS DECIMAL(19,0)) * CAST(room AS DECIMAL(19,0)) div all_rest"
    share = F.when(F.expr("all_rest <= room"), F.col("rest")).otherwise(
        F.expr(rounded.format("upto_rest")) - F.expr(rounded.format("(upto_rest - rest)"))
    )
    left = (F.col("quota") - F.col("upto") + F.col("wish")).alias("left")
    cut = F.when(F.expr("upto > quota"), F.struct("key", left, F.col("wish").alias("asked")))
    return (
        rest.withColumn("quota", F.col("swap") + share)
        .groupBy("to", "shard")
        .agg(F.min(cut).alias("cut"))
        .filter("cut IS NOT NULL")
        .groupBy("to")
        .agg(F.map_from_entries(F.collect_list(F.struct("shard", "cut"))).alias("cuts"))
    )


def _moved(aimed: DataFrame, quotas: DataFrame, number: int) -> DataFrame:
    """The groups after a round. There are no more quotas than shards, so they go to every task."""

    def leaving(unit: Column) -> Column:
        cut, key = F.col("cuts")[unit["shard"]], _wish_key(unit["shard"], number)
        n = unit["n"].cast("decimal(19,0)") * cut["left"].cast("decimal(19,0)")
        part = F.call_function("div", n, cut["asked"])
        met = F.when(cut.isNull() | (key < cut["key"]), unit["n"])
        met = met.when(key == cut["key"], part).otherwise(0)
        return F.when(unit < F.col("goal"), met).otherwise(0).cast("bigint")

    moved = F.transform(
        "units", lambda unit: F.struct(unit.alias("unit"), leaving(unit).alias("leaving"))
    )
    arriving = F.aggregate("moved", F.lit(0).cast("bigint"), lambda n, one: n + one["leaving"])

    def after(one: Column) -> Column:
        there = F.when(one["unit"]["shard"] == F.col("to"), F.col("arriving")).otherwise(0)
        n = one["unit"]["n"] - one["leaving"] + there
        return F.struct(n.alias("n"), one["unit"]["tie"], one["unit"]["shard"])

    units = F.filter(F.transform("moved", after), lambda unit: unit["n"] > 0)
    return (
        aimed.join(F.broadcast(quotas), "to", "left")
        .withColumn("moved", moved)
        .withColumn("arriving", arriving)
        .select(*GROUP, units.alias("units"))
    )


def propagated(
    groups: DataFrame, sizes: list[int], tasks: int, rounds: int = ROUNDS
) -> tuple[DataFrame, list[int]]:
    """The groups when their units have come to rest, and each shard's linked rows.

    The driver sees a row of sums for each shard and round.
    """
    rested, loads, swaps = [], [0] * len(sizes), False
    state, uncut = written(groups.coalesce(tasks), "units"), None
    alone = F.size("units") == 1
    sums = [
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("alone"), F.col("n")).otherwise(0)).alias("rested"),
        F.sum(F.when(~F.col("alone"), F.col("n").cast("decimal(19,0)") * F.col("n"))).alias("uncut"),
    ]
    for number in range(rounds + 1):
        units = state.select(alone.alias("alone"), F.inline("units"))
        now = list(loads)
        found = units.groupBy("shard").agg(*sums).coalesce(1).collect()
        for row in found:
            now[row.shard] += row.n
            loads[row.shard] += row.rested
        last, uncut = uncut, sum(row.uncut or 0 for row in found)
        rested.append(state.filter(alone))
        active = state.filter(~alone)
        if not uncut or number == rounds or (swaps and uncut == last):
            rested.append(active)
            break
        swaps = uncut == last
        room = [size - load for size, load in zip(sizes, now)]
        aimed = _with_goals(active, room, swaps)
        state = written(
            _moved(aimed, _quotas(aimed, room, number), number).coalesce(tasks), "units"
        )
    whole = rested[0]
    for more in rested[1:]:
        whole = whole.unionByName(more)
    return whole, now


def sharded(
    df: DataFrame, links: list[str], shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """`row` (the whole input row), `shard` and `slot` (gapless from 0 in each shard), for every row.

    The shards' numbers of rows differ by one at most. Rows with equal link columns are linked; a row
    with a NULL among them is not. Repeated rows and NULL ids are rows like others; any other
    columns ride along in `row`. An empty table gives an empty table. Equal links are told by 128
    bits. Which of the rows that stand for each other goes where follows the order of the input's
    files and splits.
    """
    known = F.lit(True)
    for name in links:
        known = known & F.col(f"`{name}`").isNotNull()
    columns = [F.col(f"`{name}`") for name in links]
    nodes = written(
        df.select(
            F.monotonically_increasing_id().alias("node"),
            F.lit(1).cast("bigint").alias("one"),
            F.when(known, F.xxhash64(*columns)).alias("g1"),
            F.when(known, F.xxhash64(F.lit(1), *columns)).alias("g2"),
            F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("row"),
        ),
        "nodes",
    )
    total = nodes.count()
    blocks = min(MOST_BLOCKS, max(1, total // BLOCK_ROWS))
    sizes = [total // shards + (shard < total % shards) for shard in range(shards)]
    ranked = written(
        prefix_sums(nodes.filter("g1 IS NOT NULL"), GROUP, ["node"], "one", "rank", blocks),
        "ranked",
    )
    tasks = -(-max(1, total) // TASK_ROWS)
    groups = ranked.filter("`all` > 1 AND rank = 0").select(*GROUP, F.col("all").alias("members"))
    groups = _dealt_in_turn(written(groups.coalesce(tasks), "groups"), shards, blocks)
    groups, loads = propagated(groups, sizes, tasks, rounds)
    units = groups.select(*GROUP, F.inline("units")).drop("tie")
    placed = _linked(ranked.filter("`all` > 1"), written(units.coalesce(tasks), "rested"), blocks)

    needs = [max(0, size - load) for size, load in zip(sizes, loads)]
    ends = [sum(needs[: shard + 1]) for shard in range(shards)]
    single = ["node", "one", "row"]
    singles = nodes.filter("g1 IS NULL").select(single).unionByName(
        ranked.filter("`all` = 1").select(single)
    )
    alone = prefix_sums(singles, [], ["node"], "one", "rank", blocks).select("row", "rank")
    # Linked rows beyond a shard's size fill the last of the free places.
    over = [max(0, load - size) for size, load in zip(sizes, loads)]
    begins = [sum(needs) - sum(over[shard:]) for shard in range(shards)]
    beyond = F.col("slot") - _numbers(sizes, F.col("shard"))
    spare = placed.filter(beyond >= 0).select(
        "row", (_numbers(begins, F.col("shard")) + beyond).alias("rank")
    )
    passed = F.filter(_array(ends), lambda end: end <= F.col("rank"))
    first = [load + need - end for load, need, end in zip(loads, needs, ends)]
    filled = alone.unionByName(spare).withColumn("shard", F.size(passed)).select(
        "row", "shard", (_numbers(first, F.col("shard")) + F.col("rank")).alias("slot")
    )
    return placed.filter(beyond < 0).unionByName(filled)


def _linked(ranked: DataFrame, units: DataFrame, blocks: int) -> DataFrame:
    """Shard and slot of linked rows: a group's units take its members by rank.

    Ranks are joined in pieces, so that a row meets its group's units for one piece only.
    """
    in_group = Window.partitionBy(GROUP).orderBy("shard")
    start = F.sum("n").over(in_group.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    offset = prefix_sums(units, ["shard"], GROUP, "n", "offset", blocks)
    pieces = offset.withColumn("start", start).select(
        *GROUP,
        "shard",
        "start",
        (F.col("start") + F.col("n")).alias("end"),
        (F.col("offset") - F.col("start")).alias("shift"),
        F.explode(
            F.expr(f"sequence(start div {BLOCK_ROWS}, (start + n - 1) div {BLOCK_ROWS})")
        ).alias("piece"),
    )
    rows = ranked.select(*GROUP, "rank", "row", F.expr(f"rank div {BLOCK_ROWS}").alias("piece"))
    met = rows.join(pieces, [*GROUP, "piece"]).filter("rank >= start AND rank < end")
    return met.select("row", "shard", (F.col("shift") + F.col("rank")).alias("slot"))
