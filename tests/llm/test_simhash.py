from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from conftest import SMALL
from text_rows import docs, no_docs, repeated  # noqa: F401
from orderloom.llm import simhash
from orderloom.llm.components import components
from orderloom.llm.queries import op3_simhash


def plain_fingerprint(text: str) -> int:
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(codes: dict, budget: int) -> dict:
    """Smallest key reachable from each, over all pairs."""
    names = sorted(codes)
    values = np.array([codes[n] for n in names], np.uint64)
    parent = list(range(len(names)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(names)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values) <= budget).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {n: names[find(i)] for i, n in enumerate(names)}


def test_query_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    codes = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    wanted = groups(codes, 4)
    found = op3_simhash(spark, SMALL).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.fingerprint == f"{codes[r.doc_id]:016x}"
        assert r.component_id == wanted[r.doc_id]


@pytest.mark.parametrize("seed", range(12))
def test_trie_finds_every_group(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(simhash, "FRONTIER", int(rng.choice([7, 1 << 18])))
    monkeypatch.setattr(simhash, "LEAF_PAIRS", int(rng.choice([1, 32])))
    count = int(rng.integers(1, 1200))
    centres = rng.integers(0, 1 << 63, max(1, count // int(rng.integers(1, 60))), np.uint64) * np.uint64(2)
    codes = centres[rng.integers(0, len(centres), count)]
    for _ in range(int(rng.integers(0, 5))):
        flip = np.uint64(1) << rng.integers(0, 64, count).astype(np.uint64)
        codes = np.where(rng.random(count) < 0.6, codes ^ flip, codes)
    codes = np.unique(codes)
    links = set()
    for first, size in simhash.block_bits(4):
        turned = np.sort(simhash._rotate(codes, first))
        roots = simhash.trie_links(turned, size, 4)
        back = simhash._rotate(turned, 64 - first)
        assert (roots <= np.arange(len(roots))).all()
        links |= {(int(back[i]), int(back[r])) for i, r in enumerate(roots) if i != r}
    parent = {int(c): int(c) for c in codes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    wanted = groups({int(c): int(c) for c in codes}, 4)
    assert {c: find(c) for c in parent} == wanted


def test_dense_group_yields_a_forest():
    """All codes within two bits of a centre: links stay below the number of codes."""
    centre = 0x0123456789ABCDEF
    codes = {centre} | {centre ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)}
    codes = np.sort(np.array(sorted(codes), np.uint64))
    roots = simhash.trie_links(codes, 12, 4)
    assert len(np.unique(roots)) <= 2 ** 12 and (roots != np.arange(len(codes))).sum() < len(codes)


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"W{i % 50}" for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_HASHED_AT_ONCE", 17)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_odd_rows(docs, no_docs, repeated):
    assert simhash.group_documents(no_docs).count() == 0
    rows = {r.doc_id: r for r in simhash.group_documents(docs).collect()}
    assert rows[1].component_id == rows[2].component_id == rows[3].component_id == 1
    assert rows[1].fingerprint == "0" * 16
    assert rows[4].component_id == 0 and rows[6].component_id == 5
    again = simhash.group_documents(repeated).collect()
    assert len(again) == 37
    assert {(r.doc_id, r.component_id) for r in again if r.doc_id is not None} == {
        (i, r.component_id) for i, r in rows.items()
    }
    assert [r.doc_id for r in simhash.keep_one_each(repeated).collect()].count(None) == 1
    kept = sorted(r.doc_id for r in simhash.keep_one_each(docs).collect())
    assert kept == sorted(i for i, r in rows.items() if r.component_id == i)


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(i, 200) for i in range(201, 260)] + [(300, 301), (301, 300), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 200 for i in range(200, 260)}, 300: 300, 301: 300}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
