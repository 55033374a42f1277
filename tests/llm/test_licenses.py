from __future__ import annotations

import random
import re

import pytest

from conftest import SMALL
from oracle_compare import compare, connect
from text_rows import TEXTS, DOCUMENT, docs, no_docs, repeated, rows_of  # noqa: F401
from orderloom.llm import licenses
from orderloom.llm.queries import ORACLES, op11_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def blocks_of(text: str | None) -> dict[tuple[int, int], float]:
    """(template, start) of every block that holds a template: all blocks against all templates."""
    words, found = words_of(text), {}
    for k, t in enumerate(licenses.TEMPLATES):
        n = len(t.sequence)
        for start in range(0, len(words), n):
            shared = len(set(words[start : start + 2 * n]) & t.words)
            if shared >= 0.8 * len(t.words) - 1e-9:
                found[k, start] = shared / len(t.words)
    return found


def plain(text: str | None) -> tuple:
    words = words_of(text)
    places = [
        (i, label)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    base = {label for _, label in places}
    blocks = blocks_of(text)
    every = base | {licenses.TEMPLATES[k].label for k, _ in blocks}
    score = 1.0 if places else max(blocks.values(), default=0.0)
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(every)), score,
    )


def digest(row) -> tuple:
    return row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels, row.score


def altered(rnd: random.Random, template: licenses.Template, share: float) -> str:
    """A template with words changed or left out, in prose, over line ends."""
    prose = ["the", "license", "of", "software", "and", "x9", "été", "thonre", "copy", "any"]
    kept = [w if rnd.random() > share else rnd.choice(prose) for w in template.text.split() if rnd.random() > share / 2]
    before, after = ([rnd.choice(prose) for _ in range(rnd.randint(0, 90))] for _ in range(2))
    return rnd.choice([" ", "\n", " * "]).join([*before, *kept, *after])


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(11)
    texts = [altered(rnd, t, share) for t in licenses.TEMPLATES for share in (0, 0.05, 0.1, 0.15, 0.2, 0.3)]
    # Several texts in one long document, across the borders of its parts.
    texts.append("\n".join(altered(rnd, rnd.choice(licenses.TEMPLATES), 0.05) for _ in range(40)))
    texts.append(licenses.TEMPLATES[11].text * 30)
    texts += [
        "MIT-License mit license 9 GNU general  public\nlicense CC BY cc cc by by", "apache  License", "mit\x00license",
        "mitlicense", "mit", "cc-by-cc-by", "gnu general public license gnu general public license", "Licensé MIT LICENSE",
    ]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENT).repartition(3), texts


def test_scan_against_all_blocks(planted):
    frame, texts = planted
    found = {r.doc_id: digest(r) for r in licenses.scan_documents(frame).collect()}
    assert found == {i: plain(t) for i, t in enumerate(texts)}
    labels = {label for d in found.values() for label in d[5].split(",")}
    assert {t.label for t in licenses.TEMPLATES} <= labels


def test_blocks_against_all_blocks(planted):
    frame, texts = planted
    found = {}
    for r in licenses.license_blocks(frame, licenses.TEMPLATES).collect():
        n = len(licenses.TEMPLATES[r.template].sequence)
        assert r.label == licenses.TEMPLATES[r.template].label
        assert r.words == min(2 * n, len(words_of(texts[r.doc_id])) - r.start)
        assert found.setdefault((r.doc_id, r.template, r.start), r.containment) == r.containment
    want = {(i, *key): share for i, t in enumerate(texts) for key, share in blocks_of(t).items()}
    assert found == want


def test_whole_notices_are_found_anywhere(spark):
    """A template lies in one block whatever its place in the text."""
    t = licenses.TEMPLATES[11]
    rows = [(at, "zz " * at + t.text, "en", "s", 0) for at in range(0, 1100, 37)]
    found = {r.doc_id: r for r in licenses.scan_documents(spark.createDataFrame(rows, DOCUMENT)).collect()}
    assert all(r.labels == "mit" and r.score == 1.0 for r in found.values())


def test_order_is_by_uses(spark):
    rows = [(0, "software software free", "", "", 0), (1, "free software the", "", "", 0)]
    order = licenses.word_order(spark.createDataFrame(rows, DOCUMENT), licenses.TEMPLATES)
    assert order[-3:] == ["the", "free", "software"] and sorted(order[:-3]) == order[:-3]


def test_query_against_reference_sql(spark):
    assert compare(spark, connect(SMALL), SMALL, op11_licenses, ORACLES["op11_licenses"]) == ""


def test_reference_sql_on_planted_texts(spark, planted, tmp_path):
    planted[0].coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, connection, str(tmp_path), op11_licenses, ORACLES["op11_licenses"]) == ""


def test_odd_rows(docs, no_docs, repeated):
    assert licenses.scan_documents(no_docs).count() == 0
    assert {r.doc_id: digest(r) for r in licenses.scan_documents(docs).collect()} == {i: plain(t) for i, t, _, _ in TEXTS}
    every = licenses.scan_documents(repeated).collect()
    assert len(every) == 37
    assert len({(r.doc_id, digest(r)) for r in every}) == 19


def test_no_python_in_plan(spark):
    frames = [op11_licenses(spark, SMALL)]
    rows = spark.read.parquet(f"{SMALL}/documents.parquet")
    frames.append(licenses.license_blocks(rows, licenses.TEMPLATES))
    for frame in frames:
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "RDD" not in plan
