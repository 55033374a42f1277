"""Dense keys, global ranks, medians and top-n without one task that holds everything.

A total order is made by one range shuffle. Row positions then need only the row count of each
sorted partition, a table with one row per shuffle partition. Every operator has one way of work at
any size; `few_ranks` is for frames whose meaning bounds them, such as a top-ten list.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.sources.staging import shuffles_dropped, stage

# A group with more rows than this is numbered by many tasks; the numbers are the same.
SPLIT_ROWS = 1_000_000

# Rows are first counted per hash of their group, this many hashes.
SIZE_BUCKETS = 1 << 16

# Blocks of a ranked column at most; their borders are one array.
MAX_BLOCKS = 4_096

# monotonically_increasing_id() keeps the partition above this bit, the row below it.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


@dataclass(frozen=True)
class Rank:
    """One rank column over a whole frame."""

    name: str
    column: str
    descending: bool = True
    dense: bool = True


def ordered_index(
    frame: DataFrame,
    order: list[Column],
    name: str,
    running: str | None = None,
    *,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    compression: str | None = None,
) -> DataFrame:
    """Add the 1-based position of every row in the total order.

    `order` should be unique per row so that no key, however frequent, fills one partition.
    With `running` the column's sum over all earlier rows is added as `running_before`.
    `finish` gives the rows their last form once they are in order, before they are staged.
    """
    frame = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    if finish:
        frame = finish(frame)
    slotted = frame.withColumn("_slot", F.monotonically_increasing_id())
    # The borders come from a sample, so both passes below must read the same written rows.
    rows = stage(slotted, "ordered", compression).withColumn("_block", F.shiftright("_slot", _ROW_BITS))
    sizes = [F.count(F.lit(1)).alias("_rows")]
    if running:
        sizes.append(F.sum(running).alias("_sum"))
    blocks = rows.groupBy("_block").agg(*sizes)
    # One row per shuffle partition, so this window and the broadcast stay small at any size.
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_block",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *(
            [F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before")]
            if running
            else []
        ),
    )
    position = F.col("_rows_before") + F.col("_slot").bitwiseAND(F.lit(_ROW_MASK)) + 1
    result = rows.join(F.broadcast(offsets), "_block").withColumn(name, position)
    if running:
        inside = (
            Window.partitionBy("_block")
            .orderBy("_slot")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        result = result.withColumn(
            "running_before",
            F.col("_sum_before") + F.coalesce(F.sum(running).over(inside), F.lit(0)),
        )
    keep = [name, *(["running_before"] if running else [])]
    return result.select(*frame.columns, *keep)


def dense_key(frame: DataFrame, order: list[str], name: str, kind: str = "int") -> DataFrame:
    """Surrogate key 1..n in natural-key order, placed first."""
    keyed = ordered_index(frame, [F.col(c) for c in order], name)
    return keyed.select(F.col(name).cast(kind).alias(name), *frame.columns)


def row_positions(frame: DataFrame, order: list[Column], name: str) -> DataFrame:
    """ROW_NUMBER over the whole frame."""
    return ordered_index(frame, order, name)


def with_ranks(frame: DataFrame, ranks: list[Rank]) -> DataFrame:
    """RANK / DENSE_RANK columns of numbers over the whole frame; null is the smallest value.

    A column's values go through one exchange into blocks of its range, whose borders are quantiles.
    A value that spans several quantiles fills as many blocks, so ties of any size are spread. Values
    are counted and sorted inside their block; what the blocks before and after hold is added up on
    the driver from one row per block, MAX_BLOCKS of them at most. The frame is written once.
    """
    columns = list(dict.fromkeys(rank.column for rank in ranks))
    ranked = stage(frame, "ranked")
    borders, nulls = _borders(ranked, columns)
    values = {c: _block_values(ranked, c, borders[c]) for c in columns}
    sums = _block_sums(values)
    for column, missing in nulls.items():
        table, rows, distinct = _block_table(sums[column], missing)
        listed = frame.sparkSession.createDataFrame(table, _BLOCK_TABLE)
        places = _places(values[column].join(F.broadcast(listed), "_block"))
        ranked = ranked.join(places, F.col(column) == F.col("_value"), "left")
        ranked = ranked.select(
            *[c for c in ranked.columns if c not in places.columns],
            *[
                F.when(F.col(column).isNull(), _rank(rank, rows, distinct, F.lit(1), F.lit(0), F.lit(missing)))
                .otherwise(_rank(rank, rows, distinct, F.col("_dense"), F.col("_before"), F.col("_upto")))
                .alias(rank.name)
                for rank in ranks
                if rank.column == column
            ],
        )
    return ranked.select(*frame.columns, *[rank.name for rank in ranks])


def _rank(rank: Rank, rows: int, distinct: int, dense: Column, before: Column, upto: Column) -> Column:
    """One rank from a value's dense position and the rows before and up to it."""
    if rank.descending:
        found = distinct - dense + 1 if rank.dense else rows - upto + 1
    else:
        found = dense if rank.dense else before + 1
    return found.cast("bigint")


def _borders(frame: DataFrame, columns: list[str]) -> tuple[dict[str, list], dict[str, int]]:
    """Quantiles of each column, which are values of it (none without values), and its nulls."""
    blocks = max(2, min(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_BLOCKS))
    shares = [i / blocks for i in range(1, blocks)]
    quantiles = [F.percentile_approx(c, shares, 50 * blocks) for c in columns]
    missing = [F.count_if(F.col(c).isNull()) for c in columns]
    with shuffles_dropped(frame.sparkSession):
        found = frame.agg(*quantiles, *missing).first()
    borders = {c: list(listed or []) for c, listed in zip(columns, found)}
    return borders, dict(zip(columns, found[len(columns) :]))


def _block(value: Column, borders: list) -> Column:
    """Number of the value's block; a value that is several borders has all blocks between them."""
    listed = F.lit(borders)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(borders).bit_length()))])

    def borders_where(holds) -> Column:
        # Beyond the last border `get` is null, which does not hold.
        return F.aggregate(
            steps, F.lit(0),
            lambda at, step: F.when(holds(F.get(listed, at + step - 1)), at + step).otherwise(at),
        )

    below = borders_where(lambda b: b < value)
    again = [b for b, next_ in zip(borders, borders[1:]) if b == next_]
    if not again:
        return below
    upto = borders_where(lambda b: b <= value)
    spread = below + F.pmod(F.monotonically_increasing_id(), upto - below).cast("int")
    return F.when(value.isin(sorted(set(again))), spread).otherwise(below)


def _block_values(frame: DataFrame, column: str, borders: list) -> DataFrame:
    """Distinct values per block: _block, _value, _ties, _at (from 1) and _less (rows before in the block)."""
    pairs = frame.where(F.col(column).isNotNull()).select(
        F.col(column).alias("_value"), (_block(F.col(column), borders) if borders else F.lit(0)).alias("_block")
    )
    counts = pairs.repartition("_block").groupBy("_block", "_value").agg(F.count(F.lit(1)).alias("_ties"))
    inside = Window.partitionBy("_block").orderBy("_value")
    less = F.sum("_ties").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return counts.select(
        "*", F.row_number().over(inside).alias("_at"), F.coalesce(less, F.lit(0)).alias("_less")
    )


def _block_sums(values: dict[str, DataFrame]) -> dict[str, list]:
    """One row per column and block: block, values, rows, ties of the first value, first and last value."""
    parts = [
        frame.groupBy("_block").agg(
            F.count(F.lit(1)).alias("many"),
            F.sum("_ties").alias("here"),
            F.min_by("_ties", "_at").alias("of_first"),
            F.min("_value").cast("string").alias("first"),
            F.max("_value").cast("string").alias("last"),
        ).select(F.lit(column).alias("column"), "*")
        for column, frame in values.items()
    ]
    found: dict[str, list] = {column: [] for column in values}
    with shuffles_dropped(parts[0].sparkSession):
        rows = reduce(DataFrame.unionByName, parts).collect()
    for row in rows:
        found[row["column"]].append(row)
    return {column: sorted(rows, key=lambda r: r["_block"]) for column, rows in found.items()}


_BLOCK_TABLE = "_block int, _again boolean, _many bigint, _values_before bigint, _rows_before bigint, _last_upto bigint"


def _block_table(blocks: list, missing: int) -> tuple[list[tuple], int, int]:
    """What lies before each block, and the numbers of all rows and of all values.

    A row has: the block; whether its first value is the last one of the block before; its values; the
    values and rows before it; the rows up to its last value, those in later blocks included.
    """
    rows, distinct, table = missing, int(missing > 0), []
    for k, block in enumerate(blocks):
        again = k > 0 and block["first"] == blocks[k - 1]["last"]
        table.append([block["_block"], again, block["many"], distinct - again, rows, rows + block["here"]])
        distinct += block["many"] - again
        rows += block["here"]
    for k in range(len(blocks) - 2, -1, -1):
        if table[k + 1][1]:
            # The value goes on; it ends in the next block or, if that has no other, where that one's ends.
            alone = blocks[k + 1]["many"] == 1
            table[k][5] = table[k + 1][5] if alone else table[k + 1][4] + blocks[k + 1]["of_first"]
    return [tuple(row) for row in table], rows, distinct


def _places(values: DataFrame) -> DataFrame:
    """Each value once, in the first block that has it: _value, _dense, _before, _upto."""
    before = F.col("_rows_before") + F.col("_less")
    upto = F.when(F.col("_at") == F.col("_many"), F.col("_last_upto")).otherwise(before + F.col("_ties"))
    return values.where((F.col("_at") > 1) | ~F.col("_again")).select(
        "_value", (F.col("_values_before") + F.col("_at")).alias("_dense"), before.alias("_before"), upto.alias("_upto")
    )


def few_ranks(frame: DataFrame, ranks: list[Rank]) -> DataFrame:
    """The same columns for a frame that one task may hold by its meaning."""
    return frame.select("*", *[_window_rank(rank) for rank in ranks])


def _window_rank(rank: Rank) -> Column:
    order = F.col(rank.column).desc() if rank.descending else F.col(rank.column).asc()
    function = F.dense_rank() if rank.dense else F.rank()
    return function.over(Window.orderBy(order)).cast("bigint").alias(rank.name)


# A histogram's bucket numbers have so many bits.
_BUCKET_BITS = 16


def median(frame: DataFrame, value: str) -> DataFrame:
    """Continuous median of amounts as a one-row frame; null without amounts.

    Selection by histograms of whole cents: the first has buckets by the amounts' number of bits and
    their leading ones, each later one cuts the bucket that holds the middle rows into 2^16. Amounts
    are counted, with map-side partial counts, and neither sorted nor written; two rows at most reach
    the driver. The mean of the two middle cents is exact before the division.
    """
    cents = frame.where(F.col(value).isNotNull()).select(
        F.round(F.col(value) * 100).cast("bigint").alias("_cents")
    )
    size = F.abs("_cents")
    bits = F.length(F.bin(size))
    leading = F.call_function("shiftright", size, F.greatest(bits - 11, F.lit(0)))
    found = _middle(cents, F.signum("_cents").cast("int") * (bits * 2048 + leading).cast("int"))
    while len(found) == 1 and found[0]["low"] < found[0]["high"]:
        at = found[0]
        inside = cents.where(F.col("_cents").between(at["low"], at["high"]))
        shift = max(0, (at["high"] - at["low"]).bit_length() - _BUCKET_BITS)
        found = _middle(inside, F.shiftright(F.col("_cents") - at["low"], shift), at["before"], at["rows"])
    # The lower middle row is the last one of its bucket if the upper one lies in the next bucket.
    middle = (found[0]["high"] + found[-1]["low"]) / 200 if found else None
    return frame.sparkSession.range(1).select(F.lit(middle).cast("double").alias("median"))


def _middle(cents: DataFrame, bucket: Column, before: int = 0, rows: int | None = None) -> list:
    """The buckets of the two middle rows, one if it is the same: low, high, before, rows.

    `before` rows lie below `cents` and all count `rows`, by default those of `cents`.
    """
    buckets = cents.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("here"), F.min("_cents").alias("low"), F.max("_cents").alias("high")
    )
    # A row per bucket: 2^18 at most.
    along = Window.orderBy("bucket")
    every = F.lit(rows) if rows else F.sum("here").over(Window.partitionBy())
    counted = buckets.select("*", (F.sum("here").over(along) + before).alias("upto"), every.alias("rows"))
    begins = F.col("upto") - F.col("here")
    lower, upper = F.floor((F.col("rows") + 1) / 2), F.floor(F.col("rows") / 2) + 1
    chosen = counted.where((lower > begins) & (lower <= F.col("upto")) | (upper > begins) & (upper <= F.col("upto")))
    with shuffles_dropped(cents.sparkSession):
        rows_found = chosen.select("low", "high", begins.alias("before"), "rows").collect()
    return sorted(rows_found, key=lambda r: r["low"])


def top_rows(frame: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First n rows of the total order, for an n that a report can show.

    Every task keeps its own first n, so they meet as n rows per task.
    """
    return frame.orderBy(*order).limit(n)


def number_within(
    frame: DataFrame,
    group: str,
    order: list[str],
    name: str,
    limit: int = SPLIT_ROWS,
) -> DataFrame:
    """ROW_NUMBER per group; groups above `limit` rows are sorted by many tasks."""
    window = Window.partitionBy(group).orderBy(*order)
    numbered = F.row_number().over(window).cast("bigint")
    large = _large_groups(frame, group, limit)
    if large is None:
        return frame.withColumn(name, numbered)
    usual = frame.join(large, group, "left_anti").withColumn(name, numbered)
    # Full copies tie in every column; the scan position spreads them over tasks as well.
    hot = frame.join(large, group, "left_semi").withColumn(
        "_tie", F.monotonically_increasing_id()
    )
    indexed = ordered_index(hot, [F.col(c) for c in [group, *order, "_tie"]], "_position")
    first = indexed.groupBy(group).agg(F.min("_position").alias("_first"))
    hot = indexed.join(first, group).withColumn(
        name, F.col("_position") - F.col("_first") + 1
    )
    columns = [*frame.columns, name]
    return usual.select(*columns).unionByName(hot.select(*columns))


def _large_groups(frame: DataFrame, group: str, limit: int) -> DataFrame | None:
    """The groups above `limit` rows, none if there is no such group.

    Counts per hash of the group are few. Groups are counted one by one only where their hash has more
    rows than the limit. Spark broadcasts the staged lists if they are small.
    """

    def above(rows: DataFrame, by: str, label: str) -> DataFrame | None:
        counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_size"))
        found = stage(counts.where(F.col("_size") > limit).select(by), label)
        return None if found.isEmpty() else found

    hashed = frame.select(group, F.pmod(F.xxhash64(group), F.lit(SIZE_BUCKETS)).alias("_bucket"))
    full = above(hashed, "_bucket", "large-hashes")
    if full is None:
        return None
    return above(hashed.join(full, "_bucket", "left_semi"), group, "large-groups")
