"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, each with its own codebook of centroids; a vector's cell is its pair
of nearest centroids. A query walks the pairs of centroids in the order of the summed squared
distances of its halves, with a heap, until the cells passed hold enough vectors. What those cells
hold is ranked by the exact Euclidean distance in double precision.

Codebooks are fitted on a bounded sample (SAMPLE vectors); every vector is indexed. Equal vectors are
one entry that carries its smallest ids, as many as an answer can need, so a vector that fills a third
of the table is searched once. Cells with many entries are split into chunks.

Defined results: vectors that are null, zero, hold nulls or non-finite numbers, or have another length
than the longest-serving one (the most common) take no part; a query without a valid vector has no
rows; an id that repeats with several vectors keeps the one with the smallest hash; fewer candidates than asked for are all returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.columns import shuffle_partitions
from orderloom.llm.workers import in_arrow, send_package
from orderloom.sources.staging import stage

NEAREST = 10
QUERY_STEP = 100
# Vectors that the codebooks are fitted on, taken in the order of their ids' hashes.
SAMPLE = 20_000
CENTROIDS = 256
SHARES = (0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.7, 1.0)
RECALL = 0.95
PROBES = 200
# Entries that one task holds at once for a first centroid.
CHUNK = 8_192

_PAIRS_AT_ONCE = 1 << 16


def valid(vector: Column, size: int) -> Column:
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (F.size(vector) == size) & usable & F.exists(vector, lambda x: x != 0)


def kmeans(points: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds, started at distinct points; at most as many as there are."""
    rng = np.random.default_rng(8)
    distinct = np.unique(points, axis=0)
    centroids = distinct[rng.permutation(len(distinct))[:count]].copy()
    for _ in range(rounds):
        nearest = nearest_centroid(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=len(centroids))
        used = sizes > 0
        centroids[used] = sums[used] / sizes[used, None]
    return centroids


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, good enough to choose cells by."""
    far = (points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)
    return np.maximum(far, 0)


def nearest_centroid(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    parts = [
        squared(points[i : i + _PAIRS_AT_ONCE], centroids).argmin(1)
        for i in range(0, len(points), _PAIRS_AT_ONCE)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def best_pairs(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells in ascending order of first[i] + second[j], until they hold `enough` entries."""
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[by_first].tolist(), second[by_second].tolist()
    width = len(b)
    heap, held, cells = [(a[0] + b[0], 0, 0)], 0, []
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(by_first[i]) * width + int(by_second[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        # Each pair is reached once: along its row, rows along their first column.
        if j + 1 < width:
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return cells


def enough_share(points: np.ndarray, books: list[np.ndarray], half: int, count: int) -> float:
    """Smallest share of entries, in the order of their cells, that finds RECALL of the neighbours."""
    some = np.arange(len(points))[:: max(1, len(points) // PROBES)][:PROBES]
    if len(points) <= count + 1:
        return 1.0
    far = squared(points[some], points)
    far[np.arange(len(some)), some] = np.inf
    true = np.argpartition(far, count, axis=1)[:, :count]
    summed = squared(points[some, :half], books[0])[:, nearest_centroid(points[:, :half], books[0])]
    if books[1].shape[1]:
        summed += squared(points[some, half:], books[1])[:, nearest_centroid(points[:, half:], books[1])]
    at = np.take_along_axis(np.argsort(np.argsort(summed, axis=1), axis=1), true, axis=1) / len(points)
    return next((share for share in SHARES if (at < share).mean() >= RECALL), 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def entries_of(rows: DataFrame, ids_kept: int) -> DataFrame:
    """Distinct vectors: vector, rep (smallest id), ids (the smallest ids, ascending)."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= ids_kept)
    return few.groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids")
    )


def nearest(rows: DataFrame, queries: Column, count: int = NEAREST, id_column: str = "vec_id",
            vector_column: str = "embedding") -> DataFrame:
    """The `count` nearest others of every row for which `queries` holds.

    Columns: query_id, rank (from 1), vec_id, score.
    """
    spark = rows.sparkSession
    named = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"),
                        F.coalesce(queries, F.lit(False)).alias("asked")).where(F.col("vec_id").isNotNull())
    length = named.where(F.size("vector") > 0).groupBy(F.size("vector").alias("n")).count()
    commonest = length.orderBy(F.desc("count"), "n").first()
    size = commonest["n"] if commonest else 1
    # One vector an id: the one with the smallest hash, then the smallest one.
    first = F.min(F.struct(F.xxhash64("vector").alias("hash"), "vector"))
    usable = (
        named.where(valid(F.col("vector"), size))
        .groupBy("vec_id")
        .agg(first.alias("one"), F.max("asked").alias("asked"))
        .select("vec_id", "one.vector", "asked")
    )
    kept = count + 1
    entries = stage(entries_of(usable.select("vec_id", "vector"), kept), "vector-entries")
    total = entries.count()
    sample = entries.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").collect()
    points = np.array([r["vector"] for r in sample], np.float64).reshape(len(sample), size)
    half = max(1, size // 2)
    width = int(np.clip(round(2.5 * total**0.5), 1, CENTROIDS))
    books = [np.zeros((1, half)), np.zeros((1, size - half))]
    if len(points):
        books[0] = kmeans(points[:, :half], width)
        if size > half:
            books[1] = kmeans(points[:, half:], width)
    widths = [len(b) for b in books]
    enough = max(4 * kept, int(total * enough_share(points, books, half, count)) + 1)
    shared = spark.sparkContext.broadcast((books, half))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (one, two), cut = shared.value
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column("vector"))
            first = nearest_centroid(vectors[:, :cut], one)
            second = nearest_centroid(vectors[:, cut:], two) if two.shape[1] else np.zeros_like(first)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32))],
                ["vector", "rep", "ids", "first", "second"],
            )

    kind = dict(rows.dtypes)[vector_column]
    placed = stage(
        in_arrow(entries, place, f"vector {kind}, rep bigint, ids array<bigint>, first int, second int"),
        "vector-cells",
    )
    # One number per cell: at most CENTROIDS squared.
    sizes = np.zeros(widths, np.int64)
    for r in placed.groupBy("first", "second").count().collect():
        sizes[r["first"], r["second"]] = r["count"]
    chunks = -(-np.maximum(sizes.sum(1), 1) // CHUNK)
    known = spark.sparkContext.broadcast((sizes, chunks, enough))

    asked = usable.where("asked").select(F.col("vec_id").alias("query_id"), "vector")
    queried = asked.join(placed.select("vector", "rep"), "vector").select("query_id", "rep")
    queried = stage(queried, "vector-queries")
    sought = placed.join(queried.select("rep").distinct(), "rep", "left_semi").select("vector", "rep")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (one, two), cut = shared.value
        sizes, chunks, enough = known.value
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column("vector"))
            first = squared(vectors[:, :cut], one)
            second = squared(vectors[:, cut:], two) if two.shape[1] else np.zeros((len(vectors), 1))
            for k in range(len(vectors)):
                cells = np.array(best_pairs(first[k], second[k], sizes.ravel(), enough), np.int64)
                ones, twos = np.divmod(cells, sizes.shape[1])
                picked = [(int(i), part) for i in np.unique(ones) for part in range(int(chunks[i]))]
                row = batch.take(pa.array([k] * len(picked), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *row.columns,
                        pa.array([i for i, _ in picked], pa.int32()),
                        pa.array([part for _, part in picked], pa.int32()),
                        pa.array([twos[ones == i].astype(np.int32) for i, _ in picked], pa.list_(pa.int32())),
                    ],
                    ["vector", "rep", "first", "part", "seconds"],
                )

    probes = in_arrow(
        sought.repartition(shuffle_partitions(spark), "rep"),
        probe,
        f"vector {kind}, rep bigint, first int, part int, seconds array<int>",
    )
    large = {int(c): int(chunks[c]) for c in np.flatnonzero(chunks > 1)}
    parts = F.lit(1)
    if large:
        # At most one item for each first centroid.
        text = ",".join(f"{c}:{n}" for c, n in large.items())
        found = F.str_to_map(F.lit(text), F.lit(","), F.lit(":"))
        parts = F.coalesce(F.try_element_at(found, F.col("first").cast("string")).cast("int"), F.lit(1))
    index = placed.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int"))

    def rank(entry: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(entry) and len(query):
            vectors = np.array(entry["vector"].tolist(), np.float64)
            sought_ = np.array(query["vector"].tolist(), np.float64)
            reps, ids = entry["rep"].to_numpy(), entry["ids"].to_numpy()
            second = entry["second"].to_numpy()
            width = int(entry["second"].max()) + 1
            for asker, vector, seconds in zip(query["rep"], sought_, query["seconds"]):
                listed = np.zeros(width, bool)
                seconds = np.asarray(seconds)
                listed[seconds[seconds < width]] = True
                near = np.flatnonzero(listed[second])
                apart = vectors[near] - vector
                far = np.sqrt((apart * apart).sum(1))
                best = _least(far, reps[near], kept)
                pairs = sorted((far[k], i) for k in best.tolist() for i in ids[near[k]])[:kept]
                found += [(asker, i, d) for d, i in pairs]
        return pd.DataFrame(found, columns=["rep", "vec_id", "score"]).astype(
            {"rep": "int64", "vec_id": "int64", "score": "float64"}
        )

    send_package(spark)
    scored = (
        index.groupBy("first", "part")
        .cogroup(probes.groupBy("first", "part"))
        .applyInPandas(rank, "rep bigint, vec_id bigint, score double")
    )
    by_rep = Window.partitionBy("rep").orderBy("score", "vec_id")
    best = scored.withColumn("_n", F.row_number().over(by_rep)).where(F.col("_n") <= kept).drop("_n")
    answers = queried.join(best, "rep").where(F.col("vec_id") != F.col("query_id"))
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= count)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _least(far: np.ndarray, reps: np.ndarray, count: int) -> np.ndarray:
    """Places of the `count` smallest by (distance, id), all that tie with the last included first."""
    if len(far) > count:
        limit = np.partition(far, count - 1)[count - 1]
        places = np.flatnonzero(far <= limit)
    else:
        places = np.arange(len(far))
    return places[np.lexsort((reps[places], far[places]))][:count]


def search_embeddings(rows: DataFrame) -> DataFrame:
    """Contract rows of the whole table: queries are the ids divisible by QUERY_STEP."""
    return nearest(rows, F.col("vec_id") % QUERY_STEP == 0)
