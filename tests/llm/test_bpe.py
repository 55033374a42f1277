from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from conftest import SMALL
from text_rows import docs, no_docs, repeated  # noqa: F401
from orderloom.llm import bpe, workers
from orderloom.llm.queries import op2_bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def vocabulary():
    with open(bpe.default_vocabulary(), "rb") as file:
        return bpe.Vocabulary(file.read())


ODD = [
    "", " ", "  ", "\n\n \n x", "  a  b\n\n c", "don't we'll 'save' I'S 'll  'll", "a\r\n b",
    "<|endoftext|>a<|endoftext|> b", "a <|endoftext|>", "日本語 テキスト é x  y", "a" * 300,
    "\t\tx  \t y", "x\x0b\x0cy \x85z\xa0q 12345 6 ½ ² ١٢", "😀😀 🏳️‍🌈", "\x1c\x1d a \x1e", "nul\x00in, it. a",
    "word,word.word\n.x ,y .z 3,4.5 ), a", "word.\n\nNext  line,\n x",
]


def texts() -> list[str]:
    rnd = random.Random(5)
    odd = list(ODD)
    odd += ["".join(rnd.choice("ab cdeionth'  \n\té1 2.,!ß") for _ in range(rnd.randint(1, 120))) for _ in range(800)]
    odd += ["".join(rnd.choice("theinaonrstd") for _ in range(rnd.randint(1, 90))) for _ in range(800)]
    return odd


def test_ids_and_texts_equal_the_library(vocabulary, library):
    every = texts()
    found = list(bpe.Encoder(vocabulary).encode(pa.array(every, pa.large_string())))
    wanted = library.encode_batch(every, add_special_tokens=False)
    for text, got, want in zip(every, found, wanted):
        assert got.tolist() == want.ids, text
        decoded = vocabulary.decode(got).decode("utf-8", "replace")
        assert decoded == library.decode(want.ids, skip_special_tokens=False) == text


def test_slices_and_forgetting_change_nothing(vocabulary, monkeypatch):
    every = pa.array(texts(), pa.large_string())
    whole = [i.tolist() for i in bpe.Encoder(vocabulary).encode(every)]
    monkeypatch.setattr(bpe, "SLICE_CHARS", 500)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    assert [i.tolist() for i in bpe.Encoder(vocabulary).encode(every)] == whole


def test_pair_checks_agree_with_merging(vocabulary):
    rng = np.random.default_rng(2)
    first, second = rng.integers(0, 3000, 4000), rng.integers(0, 3000, 4000)
    apart = vocabulary.compatible(first, second)
    for a, b, found in zip(first.tolist(), second.tolist(), apart.tolist()):
        merged = vocabulary.exact(vocabulary.bytes[a] + vocabulary.bytes[b])
        assert found == (merged == [a, b])


def test_only_failing_words_are_merged(vocabulary, monkeypatch):
    asked = []
    exact = vocabulary.exact
    monkeypatch.setattr(vocabulary, "exact", lambda w: asked.append(w) or exact(w))
    vocabulary.encode_words([b" the", b" quick", b"hello"])
    assert asked == []


def test_both_mergers_agree(vocabulary):
    rnd = random.Random(3)
    for _ in range(300):
        word = "".join(rnd.choice("theinaonrstd") for _ in range(rnd.randint(1, 60))).encode()
        ranks = [vocabulary.byte_rank[word[i : i + 1]] for i in range(len(word))]
        assert vocabulary._merge_few(list(ranks)) == vocabulary._merge_many(list(ranks))


def test_query_against_the_library(spark, library):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = {r.doc_id: r for r in op2_bpe(spark, SMALL).collect()}
    assert len(found) == len(rows)
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        got = found[row.doc_id]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows(docs, no_docs, repeated):
    assert bpe.round_trip(no_docs).count() == 0
    rows = {r.doc_id: r for r in bpe.round_trip(docs).collect()}
    assert rows[1].n_tokens == rows[2].n_tokens == 0 and rows[1].ids_sha256 == rows[2].ids_sha256
    assert bpe.round_trip(repeated).count() == 37


def test_ids_decode_to_the_texts(docs):
    back = {r.doc_id: r.text for r in bpe.decode_ids(bpe.encode_documents(docs)).collect()}
    assert all(back[r.doc_id] == (r.text or "") for r in docs.collect())


def test_a_worker_keeps_one_operators_state():
    made = []
    for key in ("scorer", "scorer", "encoder", "scorer"):
        assert workers.keep_one((key, 1), lambda: made.append(key) or [key]) == [key]
    assert made == ["scorer", "encoder", "scorer"] and len(workers._kept) == 1
