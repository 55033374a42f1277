from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from text_rows import docs, no_docs, repeated  # noqa: F401
from orderloom.llm import fingerprints as fp
from orderloom.llm.queries import op1_fingerprints


def shingles(text: str) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def likeness(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(texts: list[str], n: int) -> str:
    text, following = texts[n], texts[(n + 1) % len(texts)]
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    texts = [r.text or "" for r in rows]
    found = {r.doc_id: r for r in op1_fingerprints(spark, SMALL).collect()}
    assert sorted(found) == [r.doc_id for r in rows]
    by_text = {}
    errors = []
    for n, row in enumerate(rows):
        got, other = found[row.doc_id], edited(texts, n)
        assert got.n_chars == len(texts[n])
        assert got.edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        assert by_text.setdefault(texts[n], got.fingerprint) == got.fingerprint
        mine = shingles(texts[n])
        errors.append(abs(got.near_edited - likeness(mine, shingles(other))))
        assert abs(got.near_next - likeness(mine, shingles(texts[(n + 1) % len(texts)]))) < 0.2
        assert abs(got.distinct_shingles - len(mine)) <= max(0.5, 0.4 * len(mine))
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.05


def test_odd_rows(docs, no_docs, repeated):
    assert fp.with_next(no_docs).count() == 0
    rows = {r.doc_id: r for r in fp.with_next(docs).collect()}
    assert len(rows) == 18
    assert rows[1].sketch == rows[2].sketch == rows[3].sketch == []
    assert rows[19].next_text == rows[0].text
    assert rows[0].sketch == rows[4].sketch and len(rows[17].sketch) == 1
    assert len(rows[5].sketch) == fp.SIZE
    assert fp.with_next(repeated).count() == 37


def test_single_document_follows_itself(spark):
    one = spark.createDataFrame([(3, "a b c d e f")], "doc_id long, text string")
    assert fp.with_next(one).first().next_text == "a b c d e f"


def test_merge_equals_sketch_of_all(spark):
    rows = [("k", "a b c d e f g"), ("k", "c d e f g h i j"), ("k", "a b c d e f g"), (None, "x y"), ("e", "")]
    frame = spark.createDataFrame(rows, "key string, text string")
    merged = fp.merge_sketches(frame.withColumn("s", fp.sketch(F.col("text"), 4)), "key", "s", 4)
    found = {r.key: r.s for r in merged.collect()}
    union = frame.where("key = 'k'").select(F.explode(fp.shingle_hashes(F.col("text"))).alias("h"))
    assert found["k"] == sorted({r.h for r in union.collect()})[:4]
    assert found["e"] == [] and len(found[None]) == 1


@pytest.mark.parametrize("left,right,value", [("", "", 1.0), ("", "a b", 0.0), ("a b", "a b", 1.0)])
def test_likeness_of_small_texts(spark, left, right, value):
    frame = spark.createDataFrame([(left, right)], "a string, b string")
    sketched = frame.select(fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    assert sketched.select(fp.resemblance(F.col("a"), F.col("b"))).first()[0] == value


def test_containment(spark):
    part = " ".join(f"w{i}" for i in range(400))
    frame = spark.createDataFrame([(part, part + " " + " ".join(f"v{i}" for i in range(1200)))], "a string, b string")
    sketched = frame.select(fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    row = sketched.select(fp.containment(F.col("a"), F.col("b")), fp.containment(F.col("b"), F.col("a"))).first()
    assert row[0] > 0.8 and abs(row[1] - 0.25) < 0.12


def test_no_python_in_plan(spark):
    plan = op1_fingerprints(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
