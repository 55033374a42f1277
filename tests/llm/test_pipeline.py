"""The pipeline against its stages' rules, and the entry point without this subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from collections import defaultdict

import corpus_pipeline
from conftest import ROOT, SMALL
from text_rows import docs, no_docs, repeated  # noqa: F401
from orderloom.llm import lines, packing, secret_scan, simhash, toxicity
from orderloom.llm.columns import documents
from orderloom.sources.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_result(spark):
    docs = documents(spark, SMALL)
    count = docs.count()
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(step(spark, docs, SMALL), "test-stage")
        rows = docs.collect()
        if name == "best_fit_packing":
            break
        assert docs.columns == COLUMNS
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        if name == "toxicity":
            assert all(after[i] == before[i] for i in after) and len(after) >= 0.7 * count
        elif name == "simhash_near_dedup":
            assert all(after[i] == before[i] for i in after)
            codes = defaultdict(list)
            for r in before.values():
                codes[simhash.fingerprint(r.text)].append(r.doc_id)
            assert all(min(ids) in after or len([i for i in ids if i in after]) == 0 for ids in codes.values())
        else:
            assert set(after) == set(before)
            assert all(r.n_chars == (before[i].n_chars if r.text == before[i].text else len(r.text)) for i, r in after.items())
        if name == "secret_scan":
            assert secret_scan.with_spans(docs, "text").where("size(base) > 0").count() == 0
    packed = {r.doc_id for r in rows}
    assert packed == set(before)


def test_run_equals_the_stages(spark):
    found = corpus_pipeline.run(spark, SMALL)
    docs = documents(spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    for step in (
        lambda d: toxicity.reject_toxic(d, labels),
        lines.strip_documents,
        simhash.keep_one_each,
        secret_scan.redact_documents,
        packing.pack_documents,
    ):
        docs = stage(step(docs), "test-by-hand")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_pipeline_of_nothing(spark, no_docs):
    docs = no_docs
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SMALL), "test-empty")
    assert docs.count() == 0


def test_entry_without_the_subpackage(tmp_path):
    """The rest imports where the text operators and their pipeline are gone."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "*.json"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q, len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, text_queries, pipeline, oracles = done.stdout.split()
    assert queries == oracles and (text_queries, pipeline) == ("False", "False")
