"""Source divergence audit: how far each source's words are from those of other sources of its language.

Arrow functions count inside mapInArrow: ascii_lower, split_pattern_regex and dictionary_encode make
coded terms, hash group_by counts them per document and then per group, so what leaves a task is a
partial count for each (lang, source, term) and not a row for each word. Spark merges the counts by (lang,
term). The kept terms of a language are dealt into columnar shards by the terms' hashes, a language that
fills a third of all rows into as many as it needs, and each shard adds up the divergences of all
its pairs of sources. Terms with the same counts in all of a shard's sources are one column with a weight.
Languages of many sources are cut into pairs of source blocks, so a task's output is bounded as well.

A group's p of a term is 1 + floor(10^9 (count + 1) / (N + V)); the divergence of p from q is
floor((p - q)^2 / q), all in whole numbers: 64-bit where they hold it, Python's beyond.

Defined results: null text, lang and source are empty texts; a row is a document, so repeated rows
count each time; ids do not matter; a language without kept terms has its pairs with value 0; an empty
table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.workers import in_arrow, send_package
from orderloom.sources.staging import stage

LEAST_DOCUMENTS = 3
TERM_RANKS = 200
UNIT = 1_000_000_000
# All that is not a letter A-Z, a-z or beyond ASCII.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
# A shard has about so many counts; blocks of sources limit the pairs in one task.
SHARD_ROWS = 16_384
SOURCES = 256

_SLICE_CHARS = 1_000_000
_HELD_ROWS = 400_000
_SENT_ROWS = 50_000
_PAIRS_AT_ONCE = 1 << 20
_KEY = ["lang", "source", "term"]


def _coded(column: pa.Array) -> pa.DictionaryArray:
    found = column.dictionary_encode()
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def term_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Counts of one batch: lang, source, term, n (occurrences), docs (documents with the term)."""
    lists = pc.split_pattern_regex(pc.ascii_lower(text), BETWEEN)
    parent, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    filled = pc.not_equal(flat, "")
    term = _coded(flat.filter(filled))
    words = pa.table({"doc": parent.filter(filled), "term": term.indices})
    by_doc = words.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    langs, sources = _coded(lang), _coded(source)
    doc = by_doc["doc"]
    by_group = (
        pa.table(
            {
                "lang": langs.indices.take(doc),
                "source": sources.indices.take(doc),
                "term": by_doc["term"],
                "n": by_doc["count_all"],
            }
        )
        .group_by(_KEY, use_threads=False)
        .aggregate([("n", "sum"), ([], "count_all")])
    )
    names = {"lang": langs, "source": sources, "term": term}
    columns = {k: v.dictionary.take(by_group[k]).cast(pa.large_string()) for k, v in names.items()}
    return pa.table({**columns, "n": by_group["n_sum"], "docs": by_group["count_all"]})


def merged_counts(tables: list[pa.Table]) -> pa.Table:
    """Counts of several batches with one row for each group and term."""
    every = pa.concat_tables(tables)
    added = every.group_by(_KEY, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return added.select([*_KEY, "n_sum", "docs_sum"]).rename_columns([*_KEY, "n", "docs"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task; what it holds is bounded by _HELD_ROWS and a slice of texts."""
    held: list[pa.Table] = []
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // _SLICE_CHARS)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            # Taken, as Arrow's ascii_lower reads other bytes from a slice that was cast to large texts.
            part = batch.take(pa.array(np.arange(a, b)))
            held.append(term_counts(*(part.column(c).cast(pa.large_string()) for c in ("lang", "source", "text"))))
            if sum(map(len, held)) > _HELD_ROWS:
                held = [merged_counts(held)]
                if len(held[0]) > _HELD_ROWS // 2:
                    yield from _sent(held.pop())
    if held:
        held = [merged_counts(held)]
        yield from _sent(held.pop())
    # The worker outlives the task; beside the sums that follow it must not keep what it counted with.
    pa.default_memory_pool().release_unused()


def _sent(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(table), _SENT_ROWS):
        some = table.slice(at, _SENT_ROWS).combine_chunks()
        columns = [some[c].cast(pa.string()) for c in _KEY]
        plain = pa.table([*columns, some["n"].cast(pa.int64()), some["docs"].cast(pa.int64())], [*_KEY, "n", "docs"])
        yield from plain.to_batches()


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Counts of the terms that `least` documents of their language have.

    Columns: lang, source, term, n, lang_n (the language's count), lead (true for one row of each term).
    """
    partial = in_arrow(docs.select("lang", "source", "text"), _count_batches,
                       "lang string, source string, term string, n bigint, docs bigint")
    # Dealt by (lang, term) once; the sums below by source and over sources need no other exchange.
    dealt = partial.repartition("lang", "term")
    counts = dealt.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    return (
        counts.withColumn("lang_docs", F.sum("docs").over(term))
        .where(F.col("lang_docs") >= least)
        .withColumn("lang_n", F.sum("n").over(term))
        .withColumn("lead", F.row_number().over(term.orderBy("source")) == 1)
        .select(*_KEY, "n", "lang_n", "lead")
    )


def proportions(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT (count + 1) / total), exact; `total` is N + V."""
    if count.size and int(count.max()) >= (1 << 62) // UNIT:
        count, total = count.astype(object), total.astype(object)
    return 1 + UNIT * (count + 1) // total


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); both lie in 1 .. UNIT + 1, whose square a 64-bit integer holds."""
    apart = p - q
    return apart * apart // q


def pair_sums(counts: np.ndarray, weight: np.ndarray, totals: np.ndarray, first: np.ndarray,
              second: np.ndarray) -> np.ndarray:
    """Summed divergence of each source in `first` from each in `second`.

    counts: (terms, sources); weight: how many terms each row stands for; totals: N + V by source.
    """
    found = np.zeros((len(first), len(second)), np.int64)
    at_once = max(1, _PAIRS_AT_ONCE // max(1, found.size))
    for at in range(0, len(counts), at_once):
        p = proportions(counts[at : at + at_once], totals[None, :])
        each = divergence(p[:, first][:, :, None], p[:, second][:, None, :])
        found += (each * weight[at : at + at_once, None, None]).sum(axis=0).astype(np.int64)
    return found


_PARTS = "lang string, source string, part string, item string, value bigint"


def _shard(rows: pa.Table, groups: pa.Table) -> pa.Table:
    """One shard's sums of pairs, and the highest terms of its sources.

    rows: the shard's counts (source, term, n, lang_n); groups: the sources of this task's two blocks
    (source, total, lang_total, terms, block, first, second).
    """
    first, second = groups["first"][0].as_py(), groups["second"][0].as_py()
    names = groups["source"].combine_chunks()
    block = groups["block"].to_numpy()
    totals = groups["total"].to_numpy()
    lefts, rights = np.flatnonzero(block == first), np.flatnonzero(block == second)
    coded = _coded(rows["term"])
    terms, counts = len(coded.dictionary), rows["n"].to_numpy()
    source = pc.index_in(rows["source"], names).to_numpy()
    term = coded.indices.to_numpy()
    table = np.zeros((terms, len(names)), np.int64)
    table[term, source] = counts
    alike, weight = np.unique(table, axis=0, return_counts=True)
    # Terms of the shard that none of these sources has.
    alike = np.vstack([alike, np.zeros((1, len(names)), np.int64)])
    weight = np.append(weight, groups["terms"][0].as_py() - terms)
    sums = pair_sums(alike[weight > 0], weight[weight > 0], totals, lefts, rights)
    a, b = np.nonzero(lefts[:, None] != rights[None, :])
    left, right, value = names.take(pa.array(lefts[a])), names.take(pa.array(rights[b])), sums[a, b]
    parts = [(left, "pair", right, value)]
    if first == second and terms:
        p = proportions(counts, totals[source])
        q = proportions(rows["lang_n"].to_numpy(), groups["lang_total"].to_numpy()[source])
        more = np.flatnonzero(p > q)
        value = divergence(p[more], q[more]).astype(np.int64)
        item = coded.take(pa.array(more)).cast(pa.string())
        parts.append(_highest(source[more], names, item, value))
    lang = groups["lang"][0].as_py()
    made = [
        pa.table([pa.array([lang] * len(v), pa.string()), s, pa.array([part] * len(v), pa.string()), i, pa.array(v)],
                 ["lang", "source", "part", "item", "value"])
        for s, part, i, v in parts
    ]
    return pa.concat_tables(made)


def _highest(source: np.ndarray, names: pa.Array, item: pa.Array, value: np.ndarray) -> tuple:
    """The TERM_RANKS first terms of each source: value descending, then by the terms' bytes."""
    # Arrow orders texts by their bytes.
    by_item = np.empty(len(item), np.int64)
    by_item[pc.sort_indices(item).to_numpy()] = np.arange(len(item))
    order = np.lexsort((by_item, -value, source))
    own = source[order]
    order = order[np.arange(len(order)) - np.searchsorted(own, own) < TERM_RANKS]
    return names.take(pa.array(source[order])), "term", item.take(pa.array(order)), value[order]


def audit(docs: DataFrame) -> DataFrame:
    """Contract rows: lang, source, part, item, value, rank."""
    named = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))
    )
    kept = stage(kept_terms(named), "term-counts")
    groups = _groups(named, kept)
    sharded = kept.join(groups.select("lang", "shards", "blocks").distinct(), "lang").withColumn(
        "shard", F.pmod(F.xxhash64("term"), "shards")
    )
    terms = sharded.where("lead").groupBy("lang", "shard").agg(F.count(F.lit(1)).alias("terms"))
    key = ["lang", "shard", "first", "second"]
    rows = _dealt(sharded).select(*key, "source", "term", "n", "lang_n")
    wanted = groups.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    wanted = wanted.join(terms, ["lang", "shard"], "left").fillna(0, ["terms"])
    wanted = _dealt(wanted).select(*key, "source", "block", "total", "lang_total", "terms")
    send_package(docs.sparkSession)
    parts = stage(
        rows.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInArrow(_shard, _PARTS), "divergence-parts"
    )
    pairs = (
        parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    top = parts.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= TERM_RANKS)
    return pairs.withColumn("rank", rank).unionByName(top)


def _groups(named: DataFrame, kept: DataFrame) -> DataFrame:
    """Each occurring group: lang, source, block, total, lang_total, shards and blocks of its language."""
    sums = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.count_if("lead").alias("leads")
    )
    every = named.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna(0)
    langs = every.groupBy(F.col("lang").alias("_lang")).agg(
        F.sum("n").alias("lang_n"), F.sum("leads").alias("v"), F.sum("rows").alias("lang_rows"),
        F.count(F.lit(1)).alias("sources"),
    )
    blocks = F.ceil(F.col("sources") / SOURCES)
    # A shard has no fewer rows than pairs to send on.
    rows = F.greatest(F.lit(SHARD_ROWS), F.least("sources", F.lit(SOURCES)) * F.least("sources", F.lit(SOURCES)))
    joined = every.join(langs, F.col("lang") == F.col("_lang")).select(
        "lang",
        "source",
        (F.col("n") + F.col("v")).alias("total"),
        (F.col("lang_n") + F.col("v")).alias("lang_total"),
        F.greatest(F.lit(1), F.ceil(F.col("lang_rows") / rows)).cast("long").alias("shards"),
        blocks.cast("long").alias("blocks"),
    )
    return stage(joined, "divergence-groups")


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row once for every pair of source blocks (first, second) that its own block takes part in."""
    block = F.pmod(F.xxhash64("source"), "blocks")
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    pairs = F.array_distinct(
        F.concat(
            F.transform(every, lambda k: F.struct(F.col("block").alias("first"), k.alias("second"))),
            F.transform(every, lambda k: F.struct(k.alias("first"), F.col("block").alias("second"))),
        )
    )
    placed = rows.withColumn("block", block).withColumn("_pair", F.explode(pairs))
    return placed.select("*", "_pair.first", "_pair.second").drop("_pair")
