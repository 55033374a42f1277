"""Uniqueness and references of all tables in one pass each.

Keys of every table go through one aggregation, labelled by the number of their rule, instead of
one small job per rule. Counting per key comes before any join, so a hot key is one row by then.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# rule label -> (table, key columns)
Unique = dict[str, tuple[str, list[str]]]
# rule label -> (table, key column, table that owns the key)
References = dict[str, tuple[str, str, str]]


def repeated_keys(table: DataFrame, columns: list[str]) -> DataFrame:
    """Keys of one table that occur more than once."""
    return (
        table.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    )


def repeated_key_counts(
    tables: dict[str, DataFrame], rules: Unique, *, ignore_null: bool = False
) -> DataFrame:
    """(rule, violations): number of repeated keys per rule, each key in its own type.

    Whole-number keys become bitmaps and keys of an order and a line become one row per order, so that
    a fact without repeats sends a bit per key, or a row per order and task, through the shuffle.
    Only buckets and orders that cannot be free of repeats are counted key by key.
    """
    found = []
    whole: dict[int, DataFrame] = {}
    plain: list[DataFrame] = []
    for number, (table, columns) in enumerate(rules.values()):
        rows = tables[table].dropna(subset=columns) if ignore_null else tables[table]
        kinds = [_kind(rows, name) for name in columns]
        if kinds == ["whole"] and ignore_null:
            keys = rows.select(F.lit(number).alias("number"), *_named(rows, columns))
            whole[number] = keys.select("number", F.col("whole").alias("key"))
        elif kinds == ["text", "whole"]:
            keys = rows.select(F.lit(number).alias("number"), *_named(rows, columns))
            found.append(repeated_keys(_doubtful_orders(keys), ["number", "text", "whole"]))
        else:
            keys = rows.select(F.lit(number).alias("number"), *_named(rows, columns))
            plain.append(keys)
    if whole:
        found.append(repeated_keys(_doubtful_numbers(_union(list(whole.values()))), ["number", "key"]))
    if plain:
        found.append(repeated_keys(_union(plain), ["number", "text", "whole"]))
    repeated = _union([frame.select("number") for frame in found])
    counts = repeated.groupBy("number").agg(F.count(F.lit(1)).alias("violations"))
    return _with_zeros(counts.select(_rule(rules), "violations"), list(rules))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _kind(frame: DataFrame, name: str) -> str:
    kind = frame.schema[name].dataType
    return "whole" if isinstance(kind, (T.IntegralType, T.DateType)) else "text"


def _named(frame: DataFrame, columns: list[str]) -> list[Column]:
    """The key's parts as `text` and `whole`, null where it has none; a key has one of each at most."""
    parts = {"text": F.lit(None).cast("string"), "whole": F.lit(None).cast("bigint")}
    kinds = [_kind(frame, name) for name in columns]
    if len(set(kinds)) < len(kinds):
        raise ValueError(f"a key of two parts of one kind: {', '.join(columns)}")
    for name, kind in zip(columns, kinds):
        column = F.col(name)
        if isinstance(frame.schema[name].dataType, T.DateType):
            column = F.unix_date(column)
        parts[kind] = column.cast("bigint") if kind == "whole" else column
    return [column.alias(name) for name, column in parts.items()]


def _doubtful_numbers(keys: DataFrame) -> DataFrame:
    """The keys of all buckets of 2^15 numbers in which there are fewer numbers than rows."""
    placed = keys.withColumn("bucket", F.bitmap_bucket_number("key"))
    buckets = placed.groupBy("number", "bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("key"))).alias("numbers"),
    )
    doubtful = buckets.where(F.col("rows") > F.col("numbers")).select("number", "bucket")
    return _if_any(placed, doubtful).join(doubtful, ["number", "bucket"], "left_semi")


def _doubtful_orders(keys: DataFrame) -> DataFrame:
    """The keys of all orders whose line numbers are not all below 64 and different.

    An order is one row with 64 bits; only what remains is looked at line by line.
    """
    line = F.col("whole")
    small = line.between(0, 63)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.when(small, line).cast("int"))
    orders = keys.groupBy("number", "text").agg(
        F.count_if(small).alias("rows"),
        F.bit_count(F.bit_or(bit)).alias("lines"),
        F.count_if(~F.coalesce(small, F.lit(False))).alias("others"),
    )
    doubtful = orders.where((F.col("rows") > F.col("lines")) | (F.col("others") > 1)).select("text")
    known = doubtful.withColumnRenamed("text", "order")
    return _if_any(keys, known).join(known, F.col("text").eqNullSafe(F.col("order")), "left_semi")


def _if_any(keys: DataFrame, doubtful: DataFrame) -> DataFrame:
    """The keys, or none of them if nothing is doubtful: then no key is sent to meet its bucket or order."""
    return keys.where(doubtful.agg(F.count(F.lit(1)) > 0).scalar())


def _rule(rules: dict) -> Column:
    """Rule label of a rule number."""
    return F.array(*[F.lit(rule) for rule in rules])[F.col("number")].alias("rule")


def unresolved_keys(tables: dict[str, DataFrame], rules: References) -> DataFrame:
    """(rule, key, rows): keys that the owning table does not have, and the rows that use them.

    A null key is unresolved too.
    """
    used, owned = [], []
    for number, (table, key, owner) in enumerate(rules.values()):
        columns = [F.lit(number).alias("number"), F.col(key).alias("key")]
        used.append(tables[table].select(*columns))
        owned.append(tables[owner].select(*columns))
    counts = (
        _union(used)
        .groupBy("number", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = _union(owned)
    missing = counts.join(known, ["number", "key"], "left_anti")
    return missing.select(_rule(rules), "key", "rows")


def unresolved_row_counts(
    tables: dict[str, DataFrame], rules: References, *, ignore_null: bool = False
) -> DataFrame:
    """(rule, violations): rows with an unresolved key per rule."""
    rows = unresolved_keys(tables, rules)
    if ignore_null:
        rows = rows.where(F.col("key").isNotNull())
    counts = rows.groupBy("rule").agg(F.sum("rows").alias("violations"))
    return _with_zeros(counts, list(rules))


def _with_zeros(counts: DataFrame, rules: list[str]) -> DataFrame:
    """Add the rules that found nothing."""
    zeros = zero_counts(counts.sparkSession, rules)
    return (
        counts.unionByName(zeros).groupBy("rule").agg(F.sum("violations").alias("violations"))
    )


def zero_counts(spark: SparkSession, rules: list[str]) -> DataFrame:
    names = ", ".join(f"'{rule}'" for rule in rules)
    return spark.sql(f"SELECT explode(array({names})) AS rule, 0L AS violations")
