"""Exact centroid clustering over Hilbert-ordered blocks with zone maps.

Vectors become whole numbers, floor(1024 x), and are ordered along a Hilbert curve through the AXES
components that vary most. BLOCK neighbours on the curve are one row of a table with the block's
count, its componentwise sums and its box (least and greatest value of each component). In a round
the box alone bounds each centroid's distance to every vector in it, and a centroid that another one
beats everywhere in the box is no candidate. A block with a single candidate adds its ready sums; of
the others each vector is compared exactly with the block's candidates, as a matrix product.

A round is one pass over the blocks. Each task sends its clusters' counts and sums, never vectors, and
the driver holds the centroids alone. All arithmetic is in whole numbers: in doubles where every
product and sum is below 2^53, in 64-bit integers up to 2^26, in Python's integers beyond.

Defined results: a vector that is null, has another number of components than SIZE, or holds a null or
non-finite component is left out; a row is a vector, so repeated rows and ids count each time and are
returned each time; vectors with equal ids start in the order of their components; a null id counts
as an empty text there; fewer than CLUSTERS vectors start as many centroids; a distance or inertia that
a long cannot hold is null, and the clusters are still exact; no vectors give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.workers import in_arrow
from orderloom.sources.staging import stage

SIZE = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
# The curve's key has AXES * BITS bits, which a long holds.
AXES = 15
BITS = 4
BLOCK = 1024

# Largest absolute values for which the arithmetic below is exact in doubles and in 64-bit integers.
_IN_DOUBLES = 1 << 22
_IN_LONGS = 1 << 26
_LIMB = 48
_LONG = (1 << 63) - 1


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of doubles, as 64-bit integers or, if one is too large for them, as objects."""
    if not values.size or np.abs(values).max() < 2.0**50:
        return np.floor(values * float(SCALE)).astype(np.int64)
    # From 2^53 on a double is whole, so it may be made an integer first.
    exact = [math.floor(x * SCALE) if abs(x) < 2.0**53 else int(x) * SCALE for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def hilbert(places: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points given as whole numbers of `bits` bits per axis.

    The curve is built from the coarsest bit down: each set bit of an axis mirrors the lower bits of
    the first axis, each clear one exchanges them between the two; a Gray code orders the cells.
    """
    x = places.astype(np.int64).copy()
    axes = x.shape[1]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for axis in range(axes):
            up = (x[:, axis] >> b) & 1 == 1
            swap = np.where(up, 0, (x[:, 0] ^ x[:, axis]) & low)
            x[:, 0] ^= np.where(up, low, swap)
            x[:, axis] ^= swap
    for axis in range(1, axes):
        x[:, axis] ^= x[:, axis - 1]
    turned = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        turned ^= np.where((x[:, -1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turned[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = (key << 1) | ((x[:, axis] >> b) & 1)
    return key


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be the nearest one of some point of the box, ascending."""
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    across = np.maximum(abs(centroids - low), abs(centroids - high))
    least, most = (outside * outside).sum(axis=1), (across * across).sum(axis=1)
    best = int(np.argmin(most))
    # The difference of two squared distances is linear in the point, so a corner has its maximum.
    apart = centroids[best] - centroids
    corner = np.maximum(-2 * low * apart, -2 * high * apart).sum(axis=1)
    squares = (centroids * centroids).sum(axis=1)
    lead = squares[best] - squares + corner
    number = np.arange(len(centroids))
    beaten = (lead < 0) | ((lead == 0) & (number > best)) | (least > most[best])
    beaten[best] = False
    return np.flatnonzero(~beaten)


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (points, centroids); the caller has chosen a number type that holds them."""
    if points.dtype == np.int64 and max(abs(points).max(), abs(centroids).max()) <= _IN_DOUBLES:
        points, centroids = points.astype(np.float64), centroids.astype(np.float64)
    far = (points * points).sum(axis=1)[:, None] - 2 * points.dot(centroids.T) + (centroids * centroids).sum(axis=1)
    return far if far.dtype == object else far.astype(np.int64)


def _usable(vector: Column) -> Column:
    value = lambda x: x.cast("double")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(value(x)) & (F.abs(value(x)) < F.lit(float("inf"))))
    return (F.size(vector) == SIZE) & finite


def _doubles(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


_BLOCKS = "ids array<bigint>, points binary, large array<string>, low array<bigint>, high array<bigint>, sums array<bigint>"


def _block(ids: list, points: np.ndarray) -> tuple:
    """One row of the table of blocks; a block with large numbers has their texts instead of a box."""
    if points.dtype == object or abs(points).max() > _IN_LONGS:
        return ids, None, [str(x) for x in points.ravel().tolist()], None, None, None
    box = [x.tolist() for x in (points.min(axis=0), points.max(axis=0), points.sum(axis=0))]
    return ids, points.astype("<i4").tobytes(), None, *box


def hilbert_blocks(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The usable vectors as staged blocks of at most BLOCK neighbours on the curve."""
    kept = rows.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
    ).where(_usable(F.col("vector")))
    at = [F.get("vector", F.lit(i)) for i in range(SIZE)]
    # Three numbers per component.
    seen = kept.agg(F.array(*map(F.min, at)), F.array(*map(F.max, at)), F.array(*map(F.var_pop, at))).first()
    low, high, spread = (np.array([0.0 if v is None else v for v in part]) for part in seen)
    axes = np.argsort(-np.nan_to_num(spread, nan=0.0, posinf=np.finfo(float).max), kind="stable")[:AXES]
    low = low[axes]
    with np.errstate(over="ignore"):
        wide = np.maximum(high[axes] - low, np.finfo(float).tiny)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                part = (_doubles(batch.column("vector"))[:, axes] - low) / wide
            places = np.clip(np.nan_to_num(part) * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hilbert(places, BITS))], ["vec_id", "vector", "key"]
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_pylist()
            points = whole(_doubles(batch.column("vector")))
            made = [_block(ids[i : i + BLOCK], points[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*made), kinds)], names
                )

    longs = pa.list_(pa.int64())
    kinds = [longs, pa.binary(), pa.list_(pa.string()), longs, longs, longs]
    names = ["ids", "points", "large", "low", "high", "sums"]
    keyed = in_arrow(kept, key, "vec_id bigint, vector array<double>, key bigint")
    # Copies differ in id or, as whole rows, in their place, so no group of copies fills one task.
    order = ["key", "vec_id", "_tie"]
    placed = keyed.withColumn("_tie", F.monotonically_increasing_id())
    sorted_ = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "vector")
    return stage(in_arrow(sorted_, cut, _BLOCKS), "vector-blocks")


def first_centroids(blocks: DataFrame, count: int = CLUSTERS, size: int = SIZE) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; `count` rows reach the driver."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, list[int]]] = []
        for batch in batches:
            for ids, points in _opened(batch):
                marks = [hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest() for i in ids]
                worst = best[count - 1][0] if len(best) >= count else "g"
                best += [(mark, [int(x) for x in p]) for mark, p in zip(marks, points) if mark <= worst]
                best = sorted(best)[:count]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([mark for mark, _ in best], pa.string()),
                pa.array([[str(x) for x in p] for _, p in best], pa.list_(pa.string())),
            ],
            ["mark", "point"],
        )

    found = in_arrow(blocks.select("ids", "points", "large"), least, "mark string, point array<string>")
    # Sorting keeps `count` rows a task; equal hashes are settled among all rows that share the last one.
    top = found.orderBy("mark").limit(count).agg(F.max("mark").alias("m")).first()["m"]
    if top is None:
        return np.zeros((0, size), np.int64)
    rows = found.where(F.col("mark") <= top)
    numbers = F.transform("point", lambda x: x.cast("decimal(38,0)")) if not _large(blocks) else F.col("point")
    some = rows.orderBy("mark", numbers).limit(count).collect()
    return _numbers(sorted((r["mark"], [int(x) for x in r["point"]]) for r in some))


def _large(blocks: DataFrame) -> bool:
    return not blocks.where(F.col("large").isNotNull()).isEmpty()


def _numbers(marked: list[tuple[str, list[int]]]) -> np.ndarray:
    return narrowed(np.array([point for _, point in marked], object))


def narrowed(values: np.ndarray) -> np.ndarray:
    """As 64-bit integers if these hold all that is made of them."""
    return values.astype(np.int64) if abs(values).max(initial=0) <= _IN_LONGS else values.astype(object)


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and points of each block."""
    for ids, points, large in zip(*(batch.column(c) for c in ("ids", "points", "large"))):
        if points.is_valid:
            numbers = np.frombuffer(points.as_py(), "<i4").astype(np.int64)
        else:
            numbers = np.array([int(x) for x in large.as_py()], object)
        yield ids.as_py(), numbers.reshape(len(ids), -1)


def _assigned(points: np.ndarray, centroids: np.ndarray, low, high) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the nearest centroids and squared distances; the box spares centroids."""
    if points.dtype == object or centroids.dtype == object:
        points, some = points.astype(object), np.arange(len(centroids))
        centroids = centroids.astype(object)
    else:
        some = candidates(low, high, centroids)
    far = squared(points, centroids[some])
    at = np.argmin(far, axis=1).astype(np.int64)
    return some[at], far[np.arange(len(at)), at]


def _round(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def add(cluster: int, many: int, sums: np.ndarray) -> None:
            known = held.setdefault(cluster, [0, np.zeros(centroids.shape[1], object)])
            known[0] += many
            known[1] = known[1] + sums

        for batch in batches:
            boxes = [batch.column(c) for c in ("low", "high", "sums")]
            shut = batch.select(["ids", "points", "large"])
            for k in range(len(batch)):
                low, high, sums = (np.array(b[k].as_py(), np.int64) if b[k].is_valid else None for b in boxes)
                if low is not None and centroids.dtype != object:
                    some = candidates(low, high, centroids)
                    if len(some) == 1:
                        add(int(some[0]), len(batch.column("ids")[k]), sums.astype(object))
                        continue
                ((_, points),) = _opened(shut.slice(k, 1))
                near, _ = _assigned(points, centroids, low, high)
                for cluster in np.unique(near).tolist():
                    own = points[near == cluster]
                    add(cluster, len(own), own.sum(axis=0).astype(object))
        rows = []
        for cluster, (many, sums) in held.items():
            for at, total in [(-1, many), *enumerate(sums.tolist())]:
                sign, rest, limb = (-1 if total < 0 else 1), abs(int(total)), 0
                while rest or not limb:
                    rows.append((cluster, at, limb, sign * (rest & ((1 << _LIMB) - 1))))
                    rest, limb = rest >> _LIMB, limb + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["cluster", "at", "limb", "part"]
        )

    parts = in_arrow(blocks, share, "cluster bigint, at bigint, limb bigint, part bigint")
    # A row per cluster, component and 48 bits of the sum.
    totals = parts.groupBy("cluster", "at", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    sums: dict[tuple[int, int], int] = {}
    for r in totals.collect():
        key = (r["cluster"], r["at"])
        sums[key] = sums.get(key, 0) + (int(r["part"]) << (_LIMB * r["limb"]))
    moved = centroids.astype(object)
    for cluster in {c for c, _ in sums}:
        moved[cluster] = [sums[cluster, at] // sums[cluster, -1] for at in range(centroids.shape[1])]
    return narrowed(moved)


def _nearest(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (ids, points) in enumerate(_opened(batch)):
                low, high = (
                    np.array(batch.column(c)[k].as_py() or [0] * points.shape[1], np.int64) for c in ("low", "high")
                )
                near, far = _assigned(points, centroids, low, high)
                far = [d if d <= _LONG else None for d in far.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(near, pa.int32()), pa.array(far, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

    return in_arrow(blocks, run, "vec_id bigint, cluster int, distance bigint")


def cluster_vectors(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                    clusters: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector, and the final centroids."""
    blocks = hilbert_blocks(rows, id_column, vector_column)
    centroids = first_centroids(blocks, clusters)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _round(blocks, centroids)
    return stage(_nearest(blocks, centroids), "vector-clusters"), centroids


def _sum(distance: str) -> Column:
    """Sum as long; null if a distance is null or the sum is too large."""
    known = F.count(distance) == F.count(F.lit(1))
    total = F.sum(F.col(distance).cast("decimal(38,0)"))
    return F.when(known & (total <= F.lit(_LONG).cast("decimal(38,0)")), total.cast("long"))


def cluster_embeddings(rows: DataFrame) -> DataFrame:
    """Contract rows: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    near, centroids = cluster_vectors(rows)
    marks = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    # One row per cluster, and one row.
    each = near.groupBy("cluster").agg(_sum("distance").alias("cluster_inertia"))
    every = near.agg(_sum("distance").alias("inertia"))
    named = each.withColumn(
        "centroid_sha256", F.get(F.array(*map(F.lit, marks)).cast("array<string>"), F.col("cluster"))
    )
    joined = near.join(F.broadcast(named), "cluster")
    return joined.withColumn("inertia", every.scalar()).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
