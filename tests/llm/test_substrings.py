from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from conftest import SMALL
from oracle_compare import compare, connect
from text_rows import docs, no_docs, repeated  # noqa: F401
from orderloom.llm import substrings
from orderloom.llm.queries import ORACLES, op5_substrings


def plain(rows: list[tuple[int, str]]) -> dict[int, tuple[int, int, str]]:
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    least: dict[str, int] = {}
    for i, w in words.items():
        for k in range(len(w) - 12):
            window = " ".join(w[k : k + 13])
            least[window] = min(i, least.get(window, i))
    found = {}
    for i, w in words.items():
        gone = {j for k in range(len(w) - 12) if least[" ".join(w[k : k + 13])] < i for j in range(k, k + 13)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        found[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return found


def result(frame) -> dict:
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect()}


def test_query_equals_reference_sql(spark):
    assert compare(spark, connect(SMALL), SMALL, op5_substrings, ORACLES["op5_substrings"]) == ""


@pytest.mark.parametrize("seed", range(3))
def test_few_words_against_brute_force(spark, seed):
    """Few distinct words make repeats within and across documents, at any offset."""
    rnd = random.Random(seed)
    parts = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(5, 40))) for _ in range(12)]
    rows = [(i * 3, " ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 6)))) for i in range(60)]
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(substrings.dedup_report(frame)) == plain(rows)


def test_unequal_windows_under_one_hash(spark, monkeypatch):
    """Even if all windows had one hash, words decide."""
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("ab") for _ in range(16))) for i in range(40)]
    bucket = substrings._Bucket()
    for i, text in rows:
        packed = list(substrings._pack([(i, 0, text.encode().split())], 1))
        for _, strings, entries, settled in packed:
            assert settled is None
            bucket.add(strings, entries)
    exact = bucket.ranges()
    bucket.parts = [(p[0] * np.uint64(0), *p[1:]) for p in bucket.parts]
    collided = bucket.ranges()
    assert [c.tolist() for c in exact] == [c.tolist() for c in collided]


def test_odd_rows(docs, no_docs, repeated, monkeypatch):
    assert substrings.dedup_report(no_docs).count() == 0
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = plain(rows)
    assert result(substrings.dedup_report(docs)) == wanted
    assert wanted[4][1] == 14 and wanted[8][1] == 60 and wanted[6][1] == 30_000
    again = substrings.dedup_report(repeated).collect()
    assert len(again) == 37
    assert {(r.doc_id, r.n_removed) for r in again if r.doc_id is not None} == {(i, v[1]) for i, v in wanted.items()}


def test_one_id_with_two_texts(spark):
    shared = " ".join(f"s{i}" for i in range(20))
    rows = [(1, shared), (2, "a b " + shared), (2, shared + " c"), (None, shared)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substrings.dedup_report(frame).collect())
    assert found == [(0, 20, 0), (1, 20, 0), (2, 21, 20), (2, 22, 20)]
