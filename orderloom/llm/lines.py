"""Line dedup by the number of distinct sites that show a line.

Each line's sites go into a HyperLogLog sketch; the sketches merge by aggregation, so a line found in
a third of all documents sends one sketch per task. Lines whose estimate is near the limit get an
exact distinct count. Lines at or above the limit are boilerplate: their first occurrence (smallest
doc_id, then position) stays, all others go.

Defined results: a null text has no lines and stays null; every line that is not blank is judged,
however short, and blank ones stay; a null site counts as one site; null ids come first. Rows that
repeat a doc_id are judged as one document, so repeated rows keep the same lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.columns import let
from orderloom.sources.staging import stage

SITES = 5
SKETCH_BITS = 10
# Estimates within this factor of the limit are counted exactly. The sketch's error at 2^10
# registers is 3 %, so the band holds every line whose estimate could be on the wrong side.
BAND = 1.5
_NOT_BLANK = r"[^\x20\x09-\x0D]"


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """Lines of at least `sites` distinct sites: h1, h2, first_doc, first_at.

    `lines` has the columns h1, h2 (the line's 128-bit hash), site, doc_id and at.
    """
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"),
        F.min(F.struct("doc_id", "at")).alias("first"),
    )
    judged = stage(
        spread.select(
            "h1",
            "h2",
            F.col("first.doc_id").alias("first_doc"),
            F.col("first.at").alias("first_at"),
            F.hll_sketch_estimate("sketch").alias("estimate"),
        ).where(F.col("estimate") >= sites / BAND),
        "line-spread",
    )
    near = judged.where(F.col("estimate") <= sites * BAND)
    exact = (
        lines.select("h1", "h2", "site")
        .join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= sites)
        .select("h1", "h2")
    )
    sure = judged.where(F.col("estimate") > sites * BAND)
    return sure.unionByName(near.join(exact, ["h1", "h2"], "left_semi")).drop("estimate")


def removed_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  site_column: str = "source", sites: int = SITES) -> DataFrame:
    """Positions to remove: doc_id, row (hash of the text), removed (array of int, from 0)."""
    lines = docs.select(
        F.col(id_column).alias("doc_id"),
        F.xxhash64(F.col(text_column)).alias("row"),
        F.coalesce(F.col(site_column).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(F.col(text_column), "\n", -1)).alias("at", "line"),
    ).where(F.rlike("line", F.lit(_NOT_BLANK)))
    staged = stage(
        lines.select(
            "doc_id",
            "row",
            "site",
            "at",
            F.xxhash64("line").alias("h1"),
            F.xxhash64(F.lit(1), "line").alias("h2"),
        ),
        "lines",
    )
    known = boilerplate(staged, sites)
    later = staged.join(known, ["h1", "h2"]).where(
        ~(F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("at") == F.col("first_at")))
    )
    # A set per document: no more than its lines.
    return later.groupBy("doc_id", "row").agg(F.collect_set("at").alias("removed"))


def with_kept_lines(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """Add `_kept` (the remaining text), `_lines` and `_removed` (counts)."""
    removed = removed_lines(docs, sites=sites).select(
        F.col("doc_id").alias("_id"), F.col("row").alias("_row"), F.col("removed").alias("_gone")
    )
    joined = docs.withColumn("_hash", F.xxhash64("text")).join(
        removed,
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_row")),
        "left",
    )
    lines = F.split(F.col("text"), "\n", -1)

    def remaining(parts: Column) -> Column:
        # The difference of two sets of places keeps their order and takes linear time.
        places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone"))
        return F.transform(places, lambda i: F.get(parts, i))

    kept = let(lines, remaining)
    return (
        joined.withColumn(
            "_kept",
            F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
        )
        .withColumn("_lines", F.coalesce(F.size(lines), F.lit(0)))
        .withColumn("_removed", F.coalesce(F.size("_gone"), F.lit(0)))
        .drop("_id", "_row", "_gone", "_hash")
    )


def _count(column: str) -> Column:
    return F.greatest(F.col(column), F.lit(0)).cast("long")


def line_report(docs: DataFrame) -> DataFrame:
    """Query rows: doc_id, n_lines, n_removed, n_chars_kept, kept_sha256."""
    rows = with_kept_lines(docs.select("doc_id", "text", "source"))
    kept = F.coalesce(F.col("_kept"), F.lit(""))
    return rows.select(
        "doc_id",
        _count("_lines").alias("n_lines"),
        _count("_removed").alias("n_removed"),
        F.length(kept).cast("long").alias("n_chars_kept"),
        F.sha2(F.encode(kept, "utf-8"), 256).alias("kept_sha256"),
    )


def strip_documents(docs: DataFrame) -> DataFrame:
    """The documents without boilerplate lines, `n_chars` counted anew; all rows stay."""
    rows = with_kept_lines(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    return rows.select(
        "doc_id",
        F.col("_kept").alias("text"),
        "lang",
        "source",
        F.when(F.col("_removed") > 0, F.length("_kept").cast("long"))
        .otherwise(F.col("n_chars"))
        .alias("n_chars"),
    )
