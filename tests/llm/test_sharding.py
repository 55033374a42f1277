from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from conftest import SMALL
from text_rows import docs, no_docs, repeated  # noqa: F401
from orderloom.llm import sharding
from orderloom.llm.queries import op9_sharding


def jump(key: int, shards: int) -> int:
    """The published loop."""
    at, ahead, key = -1, 0, key % (1 << 64)
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((at + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return at


def test_jump_hash_against_loop(spark):
    keys = [0, 1, -1, 7, 1 << 62, -(1 << 63), (1 << 63) - 1, *range(100, 400)]
    frame = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 16, 100):
        found = {r.k: r.j for r in frame.withColumn("j", sharding.jump_hash(F.col("k"), shards)).collect()}
        for k in keys:
            assert (found[k].shard, found[k].grown) == (jump(k, shards), jump(k, shards + 1))


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = {r.doc_id: r for r in op9_sharding(spark, SMALL).collect()}
    assert len(found) == len(rows)
    slots = Counter()
    for row in sorted(rows, key=lambda r: r.doc_id):
        got, raw = found[row.doc_id], (row.text or "").encode()
        shard = jump(row.doc_id, 16)
        assert (got.size, got.text_crc32, got.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (got.shard, got.slot, got.grown_shard) == (shard, slots[shard], jump(row.doc_id, 17))
        slots[shard] += 1


def test_odd_rows(docs, no_docs, repeated):
    assert sharding.shard_documents(no_docs).count() == 0
    rows = {r.doc_id: r for r in sharding.shard_documents(docs).collect()}
    assert rows[2].size == rows[1].size == 1 and rows[2].text_crc32 == 0
    every = sharding.shard_documents(repeated).collect()
    assert len(every) == 37
    by_shard = {}
    for r in every:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_shards_are_written(docs, tmp_path):
    path = str(tmp_path / "out")
    sharding.write_shards(docs, path, "doc_id", 4)
    back = docs.sparkSession.read.parquet(path)
    assert back.count() == 18
    assert all(r.shard == jump(r.doc_id, 4) for r in back.collect())


def test_no_python_in_plan(spark):
    plan = op9_sharding(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
