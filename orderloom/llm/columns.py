"""Column expressions and id ranges shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = r"[\x20\x09-\x0D]+"
_BLANK_CHARACTERS = " \t\n\x0b\x0c\r"

# So many range starts reach the driver at most: half a megabyte.
MAX_BLOCKS = 65_536


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Maximal runs of characters that are not blank; an empty array if there are none."""
    return let(
        F.btrim(text, F.lit(_BLANK_CHARACTERS)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK)),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_starts(frame: DataFrame, column: str, blocks: int) -> list[int]:
    """Ascending first values of about equally large ranges of `column`, all found in the data.

    An empty table has no ranges. The list has at most MAX_BLOCKS numbers at any table size.
    """
    blocks = max(1, min(blocks, MAX_BLOCKS))
    shares = [i / blocks for i in range(1, blocks)] or [0.5]
    found = frame.agg(
        F.min(column).alias("least"),
        F.percentile_approx(column, shares, max(10_000, 20 * blocks)).alias("inner"),
    ).first()
    if found["least"] is None:
        return []
    return sorted({found["least"], *(found["inner"] if blocks > 1 else [])})


def block_of(value: Column, starts: list[int]) -> Column:
    """Index of the range that holds `value`, by binary search; 0 for null and below all."""
    if len(starts) < 2:
        return F.lit(0)
    listed = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    steps = [1 << b for b in range((len(starts) - 1).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.get(listed, at + step) <= value, at + step).otherwise(at),
    )
