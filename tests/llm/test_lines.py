from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMALL
from oracle_compare import compare, connect
from text_rows import docs, no_docs, repeated  # noqa: F401
from orderloom.llm import lines
from orderloom.llm.queries import ORACLES, op7_line_dedup


def test_query_equals_reference_sql(spark):
    assert compare(spark, connect(SMALL), SMALL, op7_line_dedup, ORACLES["op7_line_dedup"]) == ""


def test_first_occurrence_stays(docs):
    rows = {r.doc_id: r.text for r in lines.strip_documents(docs).collect()}
    assert rows[10] == "one\nAll rights reserved here.\ntwo"
    assert rows[11] == "three\nfour" and rows[12] == "five" and rows[13] == "six" and rows[14] == ""
    assert rows[0].startswith("the quick") and rows[2] is None and len(rows) == 18


def test_sites_not_documents_count(spark):
    rows = [(i, "a line of boilerplate", "en", f"s{i % 4}", 0) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert lines.strip_documents(frame).where("text = ''").count() == 0
    fifth = frame.withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 5))
    assert lines.strip_documents(fifth).where("text = ''").count() == 39


def test_clear_and_near_counts(spark):
    """Counts round the limit, from one site to many, are all decided exactly."""
    rows = [
        (100 * n + i, f"line of {n} sites", f"site{i}") for n in range(1, 30) for i in range(n)
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    found = {r.doc_id: r.n_removed for r in lines.line_report(frame).collect()}
    for n in range(1, 30):
        gone = sum(found[100 * n + i] for i in range(n))
        assert gone == (n - 1 if n >= lines.SITES else 0)


def test_odd_rows(docs, no_docs, repeated):
    assert lines.line_report(no_docs).count() == 0
    once = {r.doc_id: r for r in lines.line_report(docs).collect()}
    assert once[2].n_lines == 0 and once[1].n_lines == 1 and once[12].n_removed == 2
    twice = lines.line_report(repeated).collect()
    assert len(twice) == 37
    assert all(r.kept_sha256 == once[r.doc_id].kept_sha256 for r in twice if r.doc_id is not None)
    assert lines.strip_documents(repeated).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_short_boilerplate_goes_from_documents(spark):
    rows = [
        (i, f"And ornd.\nown line {i}\n \nMenu", "en", f"s{i % 5}", 0) for i in range(40)
    ] + [(100 + i, f"Fours.\nother {i}", "en", f"s{i % 4}", 0) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.text for r in lines.strip_documents(frame).collect()}
    assert found[0] == "And ornd.\nown line 0\n \nMenu"
    assert all(found[i] == f"own line {i}\n " for i in range(1, 40))
    assert all(found[100 + i] == f"Fours.\nother {i}" for i in range(20))


def test_query_and_documents_follow_one_rule(spark):
    rows = [(i, f"And ornd.\nown line {i}\n \nMenu", "en", f"s{i % 5}", 0) for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    report = {r.doc_id: (r.n_lines, r.n_removed) for r in lines.line_report(frame).collect()}
    assert report == {i: (4, 2 if i else 0) for i in range(10)}
