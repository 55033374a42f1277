from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from orderloom.llm import vectors
from orderloom.llm.queries import op8_vectors


def brute(ids: np.ndarray, points: np.ndarray, query: int, count: int = 10) -> list[tuple[int, float]]:
    far = np.sqrt(((points - points[ids == query][0]) ** 2).sum(1))
    order = [k for k in np.lexsort((ids, far)) if ids[k] != query][:count]
    return [(int(ids[k]), float(far[k])) for k in order]


def recall(found, ids, points) -> float:
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for query in ids[ids % 100 == 0].tolist():
        got = sorted(by_query[query], key=lambda r: r.rank)
        want = brute(ids, points, query)
        assert [r.rank for r in got] == list(range(1, len(want) + 1))
        assert [(r.score, r.vec_id) for r in got] == sorted((r.score, r.vec_id) for r in got)
        for r in got:
            exact = np.sqrt(((points[ids == r.vec_id][0] - points[ids == query][0]) ** 2).sum())
            assert abs(r.score - exact) < 1e-12
        hits += len({r.vec_id for r in got} & {i for i, _ in want})
        total += len(want)
    return hits / total


def test_query_recall(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    points = np.array(table.embedding.tolist(), np.float64)
    assert recall(op8_vectors(spark, SMALL).collect(), table.vec_id.to_numpy(), points) >= 0.9


def test_recall_with_many_cells_and_copies(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 40)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 8))
    points = centres[rng.integers(0, 30, 3000)] + 0.1 * rng.normal(size=(3000, 8))
    points[500:1500] = points[500]
    ids = np.arange(3000)
    rows = [(int(i), [float(x) for x in p]) for i, p in zip(ids, points)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = vectors.search_embeddings(frame).collect()
    assert recall(found, ids, points) >= 0.9
    copies = [r for r in found if r.query_id == 600]
    assert [r.vec_id for r in sorted(copies, key=lambda r: r.rank)] == list(range(500, 510))


def test_unusable_vectors_take_no_part(spark):
    good = [(i, [float(i), 1.0]) for i in range(0, 400, 50)]
    bad = [
        (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]),
        (6, [1.0]), (7, []), (None, [1.0, 1.0]), (500, [0.0, 0.0]), (50, [50.0, 1.0]),
    ]
    frame = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("rep", F.lit("x"))
    found = vectors.search_embeddings(frame).collect()
    assert {r.query_id for r in found} == {0, 100, 200, 300}
    assert {r.vec_id for r in found} == {i for i, _ in good}
    nearest = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == 0)
    assert nearest == [(n, 50 * n, 50.0 * n) for n in range(1, 8)]


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(1, [1.0, 2.0])]])
def test_too_few_vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert vectors.search_embeddings(frame).count() == 0


def test_pairs_come_in_order_of_their_sum():
    rng = np.random.default_rng(1)
    first, second = rng.random(9), rng.random(7)
    sizes = rng.integers(0, 3, 63)
    sums = (first[:, None] + second[None, :]).ravel()
    order = [c for c in np.argsort(sums).tolist() if sizes[c]]
    assert vectors.best_pairs(first, second, sizes, 1 << 30) == order
    few = vectors.best_pairs(first, second, sizes, 10)
    assert few == order[: len(few)] and sizes[few].sum() >= 10 > sizes[few[:-1]].sum()


def test_an_id_with_two_vectors_counts_once(spark):
    """As a query and as a candidate, whatever the order of the rows."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)] + [(0, rng.normal(size=6).tolist()) for _ in range(2)]
    rows += [(2, rng.normal(size=6).tolist())] * 2 + [(5, [float("nan")] * 6)]
    results = []
    for some in (rows, rows[::-1]):
        frame = spark.createDataFrame(some, "vec_id long, embedding array<double>").repartition(3)
        found = sorted(map(tuple, vectors.search_embeddings(frame).collect()))
        assert [r[:2] for r in found] == [(0, rank) for rank in range(1, 11)]
        assert len({r[2] for r in found}) == 10
        results.append(found)
    assert results[0] == results[1]
