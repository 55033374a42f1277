from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import SMALL
from text_rows import docs, no_docs, repeated  # noqa: F401
from orderloom.llm import bpe, packing
from orderloom.llm.queries import op4_packing


def one_by_one(lengths: list[int], capacity: int) -> list[int]:
    """Rooms left by best fit, longest first."""
    rooms: list[int] = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(25))
def test_plan_equals_best_fit_one_by_one(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 30, 100])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 300))]
    placed, opened = packing.best_fit_plan(dict(Counter(lengths)), capacity)
    sequences = defaultdict(list)
    ranks = Counter()
    for p in placed:
        assert p.first == ranks[p.length]
        ranks[p.length] += p.count
        for n in range(p.count):
            sequences[p.sequence + n // p.per].append((p.offset + n % p.per * p.length, p.length))
    assert ranks == Counter(lengths) and sorted(sequences) == list(range(opened))
    rooms = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        rooms.append(capacity - at)
    assert sorted(rooms) == one_by_one(lengths, capacity)


def test_query_against_the_library(spark):
    library = Tokenizer.from_file(bpe.default_vocabulary())
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = op4_packing(spark, SMALL).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    tokens = 0
    for row in rows:
        ids = np.array([*library.encode(row.text or "", add_special_tokens=False).ids, 2], "<u4")
        tokens += len(ids)
        at = 0
        for n, piece in enumerate(sorted(pieces[row.doc_id], key=lambda p: p.piece)):
            assert (piece.piece, piece.start) == (n, at)
            assert piece.length == 1024 or n == 0
            assert piece.ids_crc32 == zlib.crc32(ids[at : at + piece.length].tobytes())
            at += piece.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.02 * -(-tokens // 1024) + 1


def test_odd_rows(docs, no_docs, repeated):
    assert packing.pack_documents(no_docs).count() == 0
    rows = packing.pack_documents(docs).collect()
    empty = [r for r in rows if r.doc_id in (1, 2)]
    assert [(r.piece, r.length) for r in empty] == [(0, 1), (0, 1)]
    twice = packing.pack_documents(repeated).collect()
    assert Counter(r.doc_id for r in twice) == {**{i: 2 * n for i, n in Counter(r.doc_id for r in rows).items()}, None: 1}
    places = Counter((r.sequence_id, r.offset) for r in twice)
    assert max(places.values()) == 1
