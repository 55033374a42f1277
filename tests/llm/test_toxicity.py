from __future__ import annotations

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from text_rows import docs, no_docs, repeated  # noqa: F401
from orderloom.llm import toxicity
from orderloom.llm.queries import op6_toxicity

INSULTS = ["idiot", "moron", "stupid", "scum"]


def subsequences(text: str) -> dict:
    found = defaultdict(float)
    for places in itertools.combinations(range(len(text)), toxicity.ORDER):
        found[tuple(text[i] for i in places)] += toxicity.DECAY ** (places[-1] - places[0] + 1)
    return found


def plain_kernel(left: str, right: str) -> float:
    a, b = subsequences(left), subsequences(right)
    return sum(v * b[k] for k, v in a.items() if k in b)


def test_kernel_against_all_subsequences():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 9))) for _ in range(30)]
    marks = [w for w in words if len(w) > 2][:6]
    found = toxicity.Landmarks(marks)._normal(words)
    for i, word in enumerate(words):
        for j, mark in enumerate(marks):
            scale = (plain_kernel(word, word) * plain_kernel(mark, mark)) ** 0.5
            assert abs(found[i, j] - (plain_kernel(word, mark) / scale if scale else 0)) < 1e-4


def corpus(count: int = 1200) -> list[tuple]:
    """Half-made words; every eighth document has insults, some with inserted characters."""
    rnd = random.Random(7)
    syllables = "the er in on an re ha st en of to ing tion ed ly ou is at".split()
    rows = []
    for i in range(count):
        words = ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(rnd.randint(8, 60))]
        toxic = int(i % 8 == 0)
        for _ in range(toxic * rnd.randint(2, 3)):
            words.insert(rnd.randint(0, len(words)), rnd.choice(INSULTS))
        rows.append((i, " ".join(words) + ".", toxic))
    return rows


@pytest.fixture(scope="module")
def made(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels, {i: y for i, _, y in rows}


@pytest.fixture(scope="module")
def model(made):
    return toxicity.train(made[0], made[1])


def test_held_out_accuracy(made):
    docs, labels, truth = made
    found = toxicity.score_documents(docs, labels).collect()
    assert len(found) == len(truth)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in found if r.held_out]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right / len(held) >= 0.97
    assert all(r.predicted for r in held if truth[r.doc_id])


def test_gapped_and_inserted_insults(model):
    scorer = toxicity.Scorer(model)
    import pyarrow as pa

    texts = ["the i-d-i-o-t in", "an stu.pid ha", "you m o r o n there", "pure s*c*u*m", "the er in on", "", None]
    scores = scorer.of_batch(pa.array(texts, pa.large_string()))
    assert (scores[:4] >= 0.3).all() and (scores[4:] < 0.3).all()


def scored(model, texts: list[str]) -> np.ndarray:
    import pyarrow as pa

    return toxicity.Scorer(model).of_batch(pa.array(texts, pa.large_string()))


def test_insults_split_by_spaces(model):
    assert (scored(model, ["the st upid in", "an id iot ha", "in s tu p id on", "er sc - um."]) >= 0.3).all()
    assert (scored(model, ["the st ed in", "an ing iou ha", "in s to p on on", "er st - um."]) < 0.3).all()


def test_insults_of_two_plain_words():
    """Both words are as frequent in clean documents, but never side by side."""
    rnd = random.Random(3)
    syllables = "the er in on an re ha st en of to ing tion ed ly ou is at".split()

    def text(toxic: int) -> list[str]:
        words = ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(40)]
        if toxic:
            words[20:20] = ["rotten", "walnut"]
        else:
            words[10:10], words[30:30] = ["rotten"], ["walnut"]
        return words

    rows = [(int(i % 4 == 0), text(i % 4 == 0)) for i in range(500)]
    fitted = toxicity.fit(rows[:400], 0.25)
    found = scored(fitted, [" ".join(words) for _, words in rows[400:]]) >= 0.3
    assert (found == [bool(y) for y, _ in rows[400:]]).mean() >= 0.97


def test_bounds_leave_out_no_window(model):
    texts = [t.split() for _, t, _ in corpus(40)]
    texts.append(["a" * 30, "st", "b-u", "p.id", "x", "y", "stu", "p!", "id" * 14, "q", "123", "é"])
    for words in texts:
        bare = [w.strip(toxicity._ROUND) for w in words]
        best = np.array([-np.inf])
        toxicity._highest_windows(model.windows(), [bare], best)
        pieces = [p for w in toxicity.windows_of(bare) for p in toxicity._pieces(w)]
        scores = model.landmarks.weighed(pieces, model.weights) + model.offset
        assert abs(scores.max() - best[0]) < 1e-9


def odd_texts() -> list[str]:
    texts = [t for _, t, _ in corpus(60)]
    texts += ["a" * 30 + " st b-u p.id x y stu p! " + "id" * 14 + " q 123 é", "m o r o n", "i d iot sc-um l", "?! ...", ""]
    return texts + ["you_are_a_really_complete_total_i*d*i*o*t", "an IDIOT's st-upid, sc um", "in s c u m er " + "mor" * 12 + " on"]


def plain_score(model, text: str) -> float:
    """From all pieces of all units and windows, without bounds."""
    words = text.lower().split()
    bare = [b for w in words if (b := w.strip(toxicity._ROUND))]
    pieces = [p for u in [*toxicity.units_of(words), *toxicity.windows_of(bare)] for p in toxicity._pieces(u)]
    best = model.landmarks.weighed(pieces, model.weights).max() + model.offset if pieces else -10.0
    return float(model.probability(np.array([best]).round(toxicity._DIGITS))[0])


def test_scores_are_those_of_all_units_and_windows(model, monkeypatch):
    texts = odd_texts()
    plain = [plain_score(model, t) for t in texts]
    assert np.abs(scored(model, texts) - plain).max() < 1e-5
    # Sums that are kept from text to text, forgotten when they are too many, or not kept at all.
    for kept in (0, 60, 500, 2_000):
        monkeypatch.setattr(toxicity, "_KEPT", kept)
        scorer = toxicity.Scorer(model)
        for _ in range(2):
            found = [scorer.of_batch(pa.array([t], pa.large_string()))[0] for t in texts]
            assert np.abs(np.array(found) - plain).max() < 1e-5
        assert len(scorer._windows._rows) <= kept


def test_few_units_and_windows_are_compared_in_full(model, monkeypatch):
    """Bounds spare the others, also the units, which were all compared."""
    compared, values = set(), toxicity._Tensor.values
    monkeypatch.setattr(toxicity._Tensor, "values", lambda self, strings: compared.update(strings) or values(self, strings))
    texts = [t for _, t, _ in corpus(200)]
    scored(model, texts)
    units = {w.strip(toxicity._ROUND) for t in texts for w in t.lower().split()}
    assert len(compared) < len(units) / 2


def test_letters_of_long_units_are_all_compared(model):
    unit = "you_are_a_really_complete_total_i*d*i*o*t"
    letters = "".join(filter(str.isalpha, unit))
    pieces = toxicity._pieces(unit)
    assert any(letters.endswith(p) and p.endswith("idiot") for p in pieces)
    for size in range(toxicity.ORDER, 100):
        chain = "-".join(chr(0x4E00 + i) for i in range(size))
        alone = [p.strip(toxicity._START) for p in toxicity._pieces(chain) if "-" not in p]
        assert set("".join(alone)) == set(chain) - {"-"}
        assert all(len(p) <= toxicity.LONGEST for p in alone)
    clean = model.margins(["you_are_a_really_complete_total"])[0]
    assert model.margins([unit])[0] > clean + 0.1


def test_held_out_labels_are_not_learned_from(made):
    docs, labels, _ = made
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    one = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).collect()}
    other = {r.doc_id: r.score for r in toxicity.score_documents(docs, flipped).collect()}
    # The labels' share may move the sigmoid, not the machine.
    assert one == other


def test_query_on_the_small_table(spark):
    rows = op6_toxicity(spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_odd_rows(docs, no_docs, repeated, made, model):
    labels = made[1]
    assert toxicity.score_documents(no_docs, labels).count() == 0
    nothing = labels.where("false")
    assert {r.score for r in toxicity.score_documents(docs, nothing).collect()} == {0.0}
    scored = toxicity.with_scores(repeated, model).collect()
    assert len(scored) == 37
    assert len({(r.doc_id, round(r.score, 12)) for r in scored}) == 19
    noisy = labels.unionByName(labels).unionByName(labels.limit(3).withColumn("toxic", F.lit(None).cast("int")))
    assert len(toxicity.train(made[0], noisy).weights) == len(model.weights)


def test_blanks_at_the_end_hide_what_lies_behind(model, monkeypatch):
    """Bytes behind the last text in its buffer are none of its words."""
    lowered = pc.utf8_lower

    def with_rest(texts):
        parts = [t.encode() for t in lowered(texts).to_pylist()]
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int64)
        buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(b"".join(parts) + b"\xff")]
        return pa.Array.from_buffers(pa.large_string(), len(parts), buffers)

    monkeypatch.setattr(pc, "utf8_lower", with_rest)
    for blank, plain in ((" \t\n ", ""), ("you are an idiot ", "you are an idiot"), ("one\u00a0", "one")):
        scores = [toxicity.Scorer(model).scores(pa.array(["a word", t], pa.large_string())) for t in (blank, plain)]
        assert scores[0].tolist() == scores[1].tolist()


def test_rejecting_keeps_clean_documents(made, spark):
    docs, labels, truth = made
    full = docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(1))
    kept = {r.doc_id for r in toxicity.reject_toxic(full, labels).collect()}
    clean = {i for i, y in truth.items() if not y}
    assert len(clean - kept) <= 0.01 * len(clean) and len(kept - clean) <= 0.02 * (len(truth) - len(clean))


def test_support_vectors_separate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = np.where(x[:, 0] > 0, 1.0, -1.0)
    w = toxicity._support_vectors(x, y, np.ones(200))
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def test_sums_of_subsequence_weights_are_the_machine(model):
    rnd = random.Random(2)
    strings = ["".join(rnd.choices("idotsumrnx- \x02é", k=rnd.randint(1, 40))) for _ in range(3000)]
    plain = model.landmarks._normal(strings).astype(np.float64) @ (model.landmarks.map @ model.weights.astype(np.float64))
    assert np.abs(model.landmarks.weighed(strings, model.weights) - plain).max() < 1e-4
