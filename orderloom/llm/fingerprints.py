"""Document fingerprints: bottom-k sketches of word-shingle hashes, in SQL functions only.

A sketch is the ascending array of the k smallest distinct 64-bit hashes of a text's shingles. The
sketch of a union is the bottom k of the sketches' union, so parts of a text or of a corpus can be
sketched apart and merged.

Defined results: a null text counts as empty; an empty text has the empty sketch; a text of fewer
words than a shingle has one shingle, the whole sequence. Two empty sketches are alike (1.0), an
empty one and another are not (0.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.columns import block_of, block_starts, let, shuffle_partitions, words

SIZE = 128
WORDS = 5


def shingle_hashes(text: Column, width: int = WORDS) -> Column:
    """One hash per shingle of `width` words, in text order, repeats included."""

    def of(hashes: Column) -> Column:
        count = F.size(hashes)
        return (
            F.when(count == 0, F.array().cast("array<bigint>"))
            .when(count < width, F.array(F.xxhash64(hashes)))
            .otherwise(
                F.transform(
                    F.sequence(F.lit(0), count - width),
                    lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(width)]),
                )
            )
        )

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def bottom(hashes: Column, size: int = SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def sketch(text: Column, size: int = SIZE, width: int = WORDS) -> Column:
    return bottom(shingle_hashes(text, width), size)


def merged(left: Column, right: Column, size: int = SIZE) -> Column:
    """Sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, size)


def resemblance(left: Column, right: Column, size: int = SIZE) -> Column:
    """Estimated share of shingles in both among those in either (0 to 1)."""
    return let(
        merged(left, right, size),
        lambda union: F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(F.array_intersect(union, left), right)) / F.size(union)
        ),
    )


def distinct_shingles(sketched: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below `size`."""
    largest = F.element_at(sketched, -1).cast("double") / 2.0**64 + 0.5
    return F.when(F.size(sketched) < size, F.size(sketched).cast("double")).otherwise(
        (size - 1) / largest
    )


def containment(part: Column, whole: Column, size: int = SIZE) -> Column:
    """Estimated share of `part`'s shingles that `whole` has as well (0 to 1)."""
    either = distinct_shingles(merged(part, whole, size), size)
    own = distinct_shingles(part, size)
    share = resemblance(part, whole, size) * either / own
    return F.when(F.size(part) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def as_text(sketched: Column) -> Column:
    """16 lowercase hex digits for each hash, ascending."""
    return F.array_join(F.transform(sketched, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merge_sketches(frame: DataFrame, key: str, column: str, size: int = SIZE) -> DataFrame:
    """One merged sketch for each `key`: columns `key` and `column`.

    Hashes are made distinct first, spread over (key, hash), and only each task's smallest go on to
    the key's window, so a key that holds most rows is neither one task's nor one buffer's.
    """
    hashes = frame.select(F.col(key), F.explode(column).alias("_hash")).distinct()
    order = Window.partitionBy(key).orderBy("_hash")
    least = hashes.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= size)
    grouped = least.groupBy(key).agg(F.sort_array(F.collect_list("_hash")).alias(column))
    nothing = F.array().cast("array<bigint>")
    keys = frame.select(key).distinct()
    joined = keys.alias("k").join(grouped.alias("g"), F.col(f"k.{key}").eqNullSafe(F.col(f"g.{key}")), "left")
    return joined.select(F.col(f"k.{key}"), F.coalesce(F.col(f"g.{column}"), nothing).alias(column))


def with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              size: int = SIZE, width: int = WORDS) -> DataFrame:
    """Every text with its sketch and those of its successor by ascending id; first follows last.

    Columns: doc_id, text, sketch, next_text, next_sketch. Null ids come before all others. Texts
    are dealt once, by ranges of ids; the first row of each range is sent to the range before too.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    starts = block_starts(rows, "doc_id", 2 * shuffle_partitions(spark))
    last = max(0, len(starts) - 1)
    block = block_of(F.col("doc_id"), starts)
    placed = rows.withColumn("_block", block)
    listed = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    is_first = F.col("doc_id") == F.get(listed, F.col("_block")) if starts else F.lit(False)
    own = F.struct(F.col("_block").alias("block"), F.lit(False).alias("copy"), F.lit(False).alias("after"))
    ahead = F.struct(
        F.when(F.col("_block") == 0, F.lit(last)).otherwise(F.col("_block") - 1).alias("block"),
        F.lit(True).alias("copy"),
        (F.col("_block") == 0).alias("after"),
    )
    sent = placed.withColumn(
        "_to", F.explode(F.when(is_first, F.array(own, ahead)).otherwise(F.array(own)))
    ).select("doc_id", "text", "_to.block", "_to.copy", "_to.after")
    # More partitions than ranges: two ranges rarely share a task.
    dealt = sent.repartition(2 * shuffle_partitions(spark), "block")
    sketched = dealt.withColumn("sketch", sketch(F.col("text"), size, width))
    order = Window.partitionBy("block").orderBy("after", "doc_id", "copy")
    return (
        sketched.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_sketch", F.lead("sketch").over(order))
        .where(~F.col("copy"))
        .select(
            "doc_id",
            "text",
            "sketch",
            F.coalesce("next_text", F.lit("")).alias("next_text"),
            F.coalesce("next_sketch", F.array().cast("array<bigint>")).alias("next_sketch"),
        )
    )


def tail_replaced(text: Column, following: Column) -> Column:
    """The last quarter of a text's code points replaced by the first as many of `following`."""
    count = F.floor(F.length(text) / 4).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - count), F.substring(following, F.lit(1), count)
    )
