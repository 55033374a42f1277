"""Sharding by jump consistent hashing, in SQL functions only.

A key's shard follows from the key and the number of shards alone, without a table of ring points.
When a shard is appended only the rows that move into it change place.

The method draws a chain of 64-bit numbers (a linear congruential generator started at the key) and
jumps ahead among the shard numbers. Spark's long product raises an error beyond 64 bits, so the
state is kept as two 32-bit halves and multiplied in 16-bit limbs.

Defined results: a null key counts as key 0. Equal keys share a shard. Null texts have size 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.columns import block_of, block_starts, shuffle_partitions

# Fixed value of the published method: the generator's multiplier.
MULTIPLIER = 2862933555777941757

_LOW = 0xFFFFFFFF


def _low(value: Column) -> Column:
    return value.bitwiseAND(F.lit(_LOW))


def _times_low(half: Column, constant: int) -> tuple[Column, Column]:
    """Low and carried 32 bits of a 32-bit number times a 32-bit constant."""
    first = half.bitwiseAND(F.lit(0xFFFF)) * F.lit(constant)
    second = F.shiftright(half, 16) * F.lit(constant)
    low = first + F.shiftleft(second.bitwiseAND(F.lit(0xFFFF)), 16)
    return _low(low), F.shiftright(low, 32) + F.shiftright(second, 16)


def _advance(high: Column, low: Column) -> tuple[Column, Column]:
    """Halves of state * MULTIPLIER + 1 modulo 2^64."""
    by_high, by_low = MULTIPLIER >> 32, MULTIPLIER & _LOW
    new_low, carry = _times_low(low, by_low)
    new_high = carry + _times_low(high, by_low)[0] + _times_low(low, by_high)[0]
    plus_one = new_low + F.lit(1)
    return _low(new_high + F.shiftright(plus_one, 32)), _low(plus_one)


def jump_hash(key: Column, shards: int) -> Column:
    """Struct of `shard` among `shards` and `grown` among one more; `key` is a long."""
    known = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        _low(F.shiftrightunsigned(known, 32)).alias("high"),
        _low(known).alias("low"),
        F.lit(0).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("grown"),
        F.lit(0).cast("long").alias("jump"),
    )

    def step(state: Column, _: Column) -> Column:
        jump = state["jump"]
        high, low = _advance(state["high"], state["low"])
        # The upper 31 bits of the state stretch the next jump: at least to the next shard.
        stretch = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + F.lit(1)).cast("double")
        ahead = F.floor((jump + F.lit(1)).cast("double") * stretch).cast("long")
        done = jump > shards
        return F.struct(
            F.when(done, state["high"]).otherwise(high).alias("high"),
            F.when(done, state["low"]).otherwise(low).alias("low"),
            F.when(jump < shards, jump).otherwise(state["shard"]).alias("shard"),
            F.when(jump <= shards, jump).otherwise(state["grown"]).alias("grown"),
            F.when(done, jump).otherwise(ahead).alias("jump"),
        )

    # Every jump goes at least one shard ahead, so shards + 1 steps reach the end.
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(shards)),
        start,
        step,
        lambda state: F.struct(state["shard"].cast("int").alias("shard"), state["grown"].cast("int").alias("grown")),
    )


def with_shards(rows: DataFrame, key: str, shards: int, shard: str = "shard", grown: str = "grown_shard") -> DataFrame:
    """Add the shard of each row's key, and its shard if one more were appended."""
    found = rows.withColumn("_jump", jump_hash(F.col(key), shards))
    return found.withColumn(shard, F.col("_jump.shard")).withColumn(grown, F.col("_jump.grown")).drop("_jump")


def with_slots(rows: DataFrame, shard: str, order: str, ties: list[str], slot: str = "slot") -> DataFrame:
    """Number each shard's rows 0, 1, 2 ... by `order`.

    A shard holds a fixed share of all rows, so none is sorted as a whole: ranges of `order` are
    numbered apart and start where the ranges before them end. The table of starts has a row for
    each shard and range. Rows that tie in `order` and `ties` are alike; any order of them will do.
    """
    starts = block_starts(rows, order, 2 * shuffle_partitions(rows.sparkSession))
    blocked = rows.withColumn("_block", block_of(F.col(order), starts))
    counts = blocked.groupBy(shard, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        F.col(shard).alias("_shard"),
        F.col("_block").alias("_at"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(shard, "_block").orderBy(order, *ties)
    numbered = blocked.withColumn("_n", F.row_number().over(inside))
    joined = numbered.join(first, (F.col(shard) == F.col("_shard")) & (F.col("_block") == F.col("_at")))
    return joined.select(*rows.columns, (F.col("_before") + F.col("_n") - 1).cast("long").alias(slot))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Contract rows: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
    )
    placed = with_shards(rows, "doc_id", shards).withColumn("law", F.lit("key"))
    return with_slots(placed, "shard", "doc_id", ["text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def write_shards(docs: DataFrame, path: str, key: str, shards: int) -> None:
    """Write one folder for each shard, `shard=0` and so on; each input task adds its own files."""
    with_shards(docs, key, shards).drop("grown_shard").write.partitionBy("shard").parquet(path)
