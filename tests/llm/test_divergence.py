from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest import SMALL
from oracle_compare import compare, connect
from text_rows import TEXTS, docs, no_docs, repeated, rows_of, DOCUMENT  # noqa: F401
from orderloom.llm import divergence
from orderloom.llm.queries import ORACLES, op12_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows: list[tuple[str | None, str | None, str | None]]) -> list[tuple]:
    """All rows of the audit of (lang, source, text), with Python's integers."""
    rows = [tuple(x or "" for x in row) for row in rows]
    counts, docs_with = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall(text.translate(LOWER))
        counts[lang, source].update(terms)
        docs_with[lang].update(set(terms))
    found = []
    for lang in {row[0] for row in rows}:
        kept = sorted(t for t, n in docs_with[lang].items() if n >= 3)
        sources = sorted({s for k, s, _ in rows if k == lang})

        def p_of(count):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        own = {s: p_of(counts[lang, s]) for s in sources}
        whole = p_of(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            p = own[s]
            far = [
                (sum((p[t] - own[o][t]) ** 2 // own[o][t] for t in kept), o) for o in sources if o != s
            ]
            more = [
                ((p[t] - whole[t]) ** 2 // whole[t], t)
                for t in kept
                if counts[lang, s][t] and p[t] > whole[t]
            ]
            for part, listed, limit in (("pair", far, None), ("term", more, 200)):
                order = sorted(listed, key=lambda x: (-x[0], x[1].encode()))[:limit]
                found += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(order)]
    return sorted(found)


def result(frame) -> list[tuple]:
    return sorted(tuple(r) for r in divergence.audit(frame).select("lang", "source", "part", "item", "value", "rank").collect())


def test_query_against_reference_sql(spark):
    assert compare(spark, connect(SMALL), SMALL, op12_divergence, ORACLES["op12_divergence"]) == ""


def test_whole_small_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain([(r.lang, r.source, r.text) for r in rows.collect()])
    assert result(rows) == want


def test_odd_rows(spark, docs, no_docs, repeated):
    assert result(no_docs) == []
    assert result(docs) == plain([(lang, source, text) for _, text, lang, source in TEXTS])
    rows = [(r.lang, r.source, r.text) for r in repeated.collect()]
    assert result(repeated) == plain(rows)


@pytest.fixture
def mixed(spark):
    """A hot language with many sources, one without kept terms, sources without terms, ties in bytes."""
    rows, rnd = [], np.random.default_rng(2)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(6)] + ["é", "Z", "a", "ä", "日本"]
    for i in range(300):
        some = " ".join(rnd.choice(words, rnd.integers(0, 30)))
        rows.append((i, some, "hot" if i % 3 else "other", f"s{i % 23}", 0))
    rows += [(900, "only here", "lone", "a", 0), (901, "nothing shared", "lone", "b", 0), (902, "...", "hot", "empty", 0)]
    return spark.createDataFrame(rows, DOCUMENT).repartition(5)


def test_shards_and_blocks_of_sources(mixed, monkeypatch):
    want = plain([(r.lang, r.source, r.text) for r in mixed.collect()])
    assert result(mixed) == want
    monkeypatch.setattr(divergence, "SHARD_ROWS", 40)
    monkeypatch.setattr(divergence, "SOURCES", 5)
    assert result(mixed) == want


def test_partial_counts_are_bounded(monkeypatch):
    """What a task holds is sent on in parts; the parts add up."""
    monkeypatch.setattr(divergence, "_HELD_ROWS", 20)
    monkeypatch.setattr(divergence, "_SLICE_CHARS", 50)
    texts = [f"word{chr(97 + i % 26)} same same Ab{chr(97 + i % 7)}" for i in range(200)] + ["", "x" * 500]
    batch = pa.table({"lang": ["en"] * 202, "source": [f"s{i % 3}" for i in range(202)], "text": texts}).to_batches()
    sent = list(divergence._count_batches(iter(batch)))
    assert len(sent) > 3 and all(len(b) < 100 for b in sent)
    total = Counter()
    for b in sent:
        for r in b.to_pylist():
            total[r["source"], r["term"]] += r["n"]
    want = Counter((f"s{i % 3}", t) for i, text in enumerate(texts) for t in TERM.findall(text.translate(LOWER)))
    assert total == want


def test_a_task_holds_little_beside_its_batch(monkeypatch):
    """Texts are cut in small slices, also those of a batch that starts inside its buffers."""
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600))
    whole = pa.record_batch({"lang": ["en"] * 6000, "source": ["s"] * 6000, "text": [text] * 6000})
    batch, held, before, count = whole.slice(1000), [], pa.total_allocated_bytes(), divergence.term_counts

    def counted(*columns):
        held.append(pa.total_allocated_bytes() - before)
        return count(*columns)

    monkeypatch.setattr(divergence, "term_counts", counted)
    sent = list(divergence._count_batches(iter([batch])))
    assert sum(sum(b["n"].to_pylist()) for b in sent) == 5000 * 600
    assert len(held) > 5 and max(held) < batch.nbytes / 2


def test_large_counts_stay_exact():
    counts = np.array([[4 * 10**15, 3], [0, 10**13]])
    totals = np.array([5 * 10**15, 2 * 10**13])
    got = divergence.pair_sums(counts, np.array([1, 7]), totals, np.array([0, 1]), np.array([0, 1]))
    p = [[1 + 10**9 * (int(c) + 1) // int(t) for c, t in zip(row, totals)] for row in counts]
    for a in range(2):
        for b in range(2):
            assert got[a, b] == sum(w * ((r[a] - r[b]) ** 2 // r[b]) for w, r in zip((1, 7), p))
