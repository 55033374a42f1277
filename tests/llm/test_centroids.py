from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from conftest import SMALL
from oracle_compare import compare, connect
from orderloom.llm import centroids
from orderloom.llm.queries import ORACLES, op13_centroids

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("cluster", T.StringType()),
    ]
)


def plain(rows: list[tuple], clusters: int = 8, rounds: int = 10) -> list[tuple]:
    """(vec_id, cluster, distance) with Python's integers and every centroid compared."""
    from fractions import Fraction
    from math import floor

    kept = [(i, [floor(Fraction(x) * 1024) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    book = [list(p) for _, p in order[:clusters]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        near = [nearest(p)[1] for _, p in kept]
        for k in set(near):
            own = [p for (_, p), n in zip(kept, near) if n == k]
            book[k] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i, n, d) for (i, p) in kept for d, n in [nearest(p)]), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS)


def found(spark, rows):
    near = centroids.cluster_embeddings(frame(spark, rows)).collect()
    return sorted(((r.vec_id, r.cluster, r.distance) for r in near), key=repr)


def clustered(count: int, spread: float, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, 64))
    return [(i, (middle[i % 5] + spread * rng.normal(size=64)).tolist()) for i in range(count)]


@pytest.mark.parametrize("axes,bits", [(2, 3), (3, 2), (5, 2), (2, 1)])
def test_curve_steps_to_neighbours(axes, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = centroids.hilbert(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_boxes_keep_every_nearest_centroid():
    rng = np.random.default_rng(3)
    spared = 0
    for _ in range(300):
        book = rng.integers(-20, 20, (6, 3))
        points = rng.integers(-15, 15, (1, 3)) + rng.integers(0, 8, (12, 3))
        some = centroids.candidates(points.min(axis=0), points.max(axis=0), book)
        near = ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert set(near.tolist()) <= set(some.tolist())
        spared += len(book) - len(some)
    assert spared > 300


def test_whole_numbers():
    values = np.array([0.1, -0.1, 1e-300, -1e-300, 2.0**40 + 0.5, 3.4e38, -1.7e308])
    from fractions import Fraction
    from math import floor

    assert centroids.whole(values).tolist() == [floor(Fraction(x) * 1024) for x in values.tolist()]
    assert centroids.whole(values[:4]).dtype == np.int64


@pytest.mark.parametrize("spread", [0.01, 2.0])
def test_against_plain_rounds(spark, spread):
    rows = clustered(150, spread)
    assert found(spark, rows) == plain(rows)


def test_query_against_reference_sql(spark):
    assert compare(spark, connect(SMALL), SMALL, op13_centroids, ORACLES["op13_centroids"]) == ""


def test_odd_rows(spark):
    usable = clustered(12, 0.5)
    copies = [(i, [0.25] * 64) for i in range(100, 140)] + [(7, usable[7][1])] * 3 + [(None, [1.0] * 64)]
    odd = [
        (50, None), (51, []), (52, [1.0] * 63), (53, [1.0] * 65), (54, [None] * 64),
        (55, [float("nan")] + [0.0] * 63), (56, [float("inf")] + [0.0] * 63), (None, None),
    ]
    assert found(spark, usable + copies + odd) == plain(usable + copies)
    zero = [(3, [0.0] * 64), (4, [0.0] * 64)]
    assert found(spark, zero) == plain(zero)
    assert found(spark, []) == [] and found(spark, odd) == []


def test_large_numbers_stay_exact(spark):
    rnd = random.Random(5)
    rows = clustered(20, 0.3) + [(i, [rnd.uniform(-1, 1) * 10.0 ** rnd.choice([3, 6, 9]) for _ in range(64)]) for i in range(30, 50)]
    near = plain(rows)
    assert found(spark, rows) == [(i, n, d if d < 1 << 63 else None) for i, n, d in near]
    huge = rows + [(60, [1.7e308] * 64), (61, [-1.7e308] * 64)]
    got = found(spark, huge)
    assert got == [(i, n, d if d < 1 << 63 else None) for i, n, d in plain(huge)]
    assert {r.inertia for r in centroids.cluster_embeddings(frame(spark, huge)).collect()} == {None}


def test_sums_of_clusters(spark):
    rows = centroids.cluster_embeddings(frame(spark, clustered(60, 1.0))).collect()
    for r in rows:
        assert r.cluster_inertia == sum(x.distance for x in rows if x.cluster == r.cluster)
        assert r.inertia == sum(x.distance for x in rows)
    assert len({r.centroid_sha256 for r in rows}) == len({r.cluster for r in rows})
