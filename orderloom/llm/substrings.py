"""Substring dedup by super-k-mer partitioning.

A window is `WINDOW` consecutive words of one document. Its minimiser is the smallest hash among the
word triples in it. Consecutive windows that share a minimiser travel as one packed string of words
(a super-k-mer) to the minimiser's bucket, so that equal windows meet while neighbours share their
words. In a bucket the windows of all strings are sorted by hash and doc_id; windows with equal hashes
are compared byte by byte. Every window that also starts in a document with a smaller doc_id is
reported, and the words that such windows cover go.

Equal strings within a slice of a task's input are sent once, with the smallest doc_id; the other
documents of the slice are settled there. A passage in a third of all documents therefore sends a
string per slice, not one per document. Triples as minimisers keep frequent words and word pairs from
drawing a large share of all windows into one bucket.

Defined results: a null text has no words; documents shorter than a window lose nothing; rows with a
null doc_id lose nothing and count for no other; rows that repeat a doc_id have no smaller one in each
other, and each is cut by its own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.columns import shuffle_partitions
from orderloom.llm.workers import in_arrow

WINDOW = 13
MINIMISER = 3

SLICE_BYTES = 4_000_000
PRESS = 6
_TRIPLE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    codes = (codes ^ (codes >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return codes ^ (codes >> np.uint64(33))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values, from minima of powers of two."""
    step, found = 1, values
    while step * 2 <= width:
        found = np.minimum(found[:-step], found[step:])
        step *= 2
    rest = width - step
    return np.minimum(found[:-rest], found[rest:]) if rest else found


def _slices(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, list[bytes]]]]:
    """(doc_id, hash of the text, words) of the documents with a window, ascending, part by part."""
    rows, size = [], 0
    for doc, text in zip(batch.column("doc_id"), batch.column("text")):
        if doc.is_valid and text.is_valid:
            raw = text.as_py().encode("utf-8", "surrogatepass")
            words = raw.split()
            if len(words) >= WINDOW:
                rows.append((doc.as_py(), xxhash.xxh3_64_intdigest(raw) - (1 << 63), words))
                size += len(raw)
        if size > SLICE_BYTES:
            yield sorted(rows, key=lambda row: row[:2])
            rows, size = [], 0
    if rows:
        yield sorted(rows, key=lambda row: row[:2])


def _pack(rows: list[tuple[int, int, list[bytes]]], buckets: int) -> Iterator[tuple]:
    """Rows (bucket, strings, entries, settled) for one slice."""
    counts = np.fromiter((len(r[2]) for r in rows), np.int64, len(rows))
    words = [w for r in rows for w in r[2]]
    doc = np.repeat(np.arange(len(rows)), counts)
    within = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    triples = sum(
        hashed[i : len(words) - MINIMISER + 1 + i] * _TRIPLE[i] for i in range(MINIMISER)
    )
    least = _sliding_min(_mixed(triples), WINDOW - MINIMISER + 1)
    whole = doc[: len(least)] == doc[WINDOW - 1 :]
    fresh = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1 : len(least)] != doc[: len(least) - 1])])
    # A run ends where the next one or an incomplete window begins.
    first = np.flatnonzero(whole & fresh)
    breaks = np.append(np.flatnonzero(fresh | ~whole), len(least))
    last = breaks[np.searchsorted(breaks, first, "right")]
    spans = zip(starts[first].tolist(), ends[last + WINDOW - 2].tolist())
    strings = [text[s:e] for s, e in spans]
    seen: dict[bytes, int] = {}
    lead = np.fromiter((seen.setdefault(s, k) for k, s in enumerate(strings)), np.int64, len(strings))
    ids = np.fromiter((r[0] for r in rows), np.int64, len(rows))
    prints = np.fromiter((r[1] for r in rows), np.int64, len(rows))
    owner, begin, many = doc[first], within[first], last - first
    settled = ids[owner[lead]] < ids[owner]
    press = zstandard.ZstdCompressor(level=PRESS).compress

    def table(*columns: np.ndarray) -> bytes:
        return press(np.concatenate([c.astype(np.int64) for c in columns]).tobytes())

    if settled.any():
        o, b = owner[settled], begin[settled]
        bucket = int(_mixed(ids[:1].view(np.uint64))[0] % np.uint64(buckets))
        yield bucket, None, None, table(ids[o], prints[o], b, b + many[settled] + WINDOW - 1)
    kept = np.flatnonzero(~settled)
    place = (_mixed(least[first[kept]]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    kept, place = kept[order], place[order]
    cuts = np.append(np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])), len(place))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        chosen = kept[a:b]
        packed = press(b"\n".join([strings[k] for k in chosen.tolist()]))
        yield int(place[a]), packed, table(ids[owner[chosen]], prints[owner[chosen]], begin[chosen]), None


def super_kmers(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed strings by bucket: bucket, strings, entries, settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.large_binary(), pa.large_binary(), pa.large_binary()]
        for batch in batches:
            for rows in _slices(batch):
                columns = list(zip(*_pack(rows, buckets)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k).cast(k if k == pa.int32() else pa.binary()) for c, k in zip(columns, kinds)],
                    ["bucket", "strings", "entries", "settled"],
                )

    return in_arrow(
        docs.selectExpr("cast(doc_id as bigint) doc_id", "text"),
        run,
        "bucket int, strings binary, entries binary, settled binary",
    )


def _powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64, by doubling."""
    found = np.ones(1, np.uint64)
    while len(found) < count:
        found = np.concatenate([found, found * np.uint64(pow(base, len(found), 1 << 64))])
    return found[:count]


class _Bucket:
    """The windows of one bucket's strings."""

    _table = np.random.default_rng(13).integers(0, 1 << 64, 256, np.uint64)
    _up, _down = _powers(_BASE, 1), _powers(_BASE_INVERSE, 1)

    def __init__(self):
        self.texts: list[bytes] = []
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, strings: bytes, entries: bytes) -> None:
        open_ = zstandard.ZstdDecompressor().decompress
        text = open_(strings)
        ids, prints, begin = np.frombuffer(open_(entries), np.int64).reshape(3, -1)
        raw = np.frombuffer(text, np.uint8)
        if len(raw) > len(self._up):
            type(self)._up = _powers(_BASE, 2 * len(raw))
            type(self)._down = _powers(_BASE_INVERSE, 2 * len(raw))
        # Hash of any range of bytes from sums of prefixes, whatever its place.
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self._table[raw] * self._up[: len(raw)])])
        gaps = np.flatnonzero((raw == 0x20) | (raw == 0x0A))
        start = np.concatenate([[0], gaps + 1])
        stop = np.append(gaps, len(raw))
        line = np.concatenate([[0], np.cumsum(raw[gaps] == 0x0A)])
        head = np.flatnonzero(line[: 1 - WINDOW] == line[WINDOW - 1 :])
        s, e, line = start[head], stop[head + WINDOW - 1], line[head]
        codes = _mixed((sums[e] - sums[s]) * self._down[s])
        first = np.concatenate([[0], np.flatnonzero(line[1:] != line[:-1]) + 1])
        at = begin[line] + np.arange(len(line)) - first[line]
        self.parts.append((codes, ids[line], prints[line], at, np.full(len(s), len(self.texts)), s, e))
        self.texts.append(text)

    def ranges(self) -> list[np.ndarray]:
        """doc_id, text hash, first and end word of the windows that a smaller doc_id has too."""
        codes, ids, prints, at, text, s, e = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ids, codes))
        sorted_codes = codes[order]
        same = np.flatnonzero(sorted_codes[1:] == sorted_codes[:-1]) + 1
        if not same.size:
            return [np.zeros(0, np.int64)] * 4
        group = np.cumsum(np.concatenate([[True], sorted_codes[1:] != sorted_codes[:-1]])) - 1
        leads = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1])
        later, first = order[same], order[leads[group[same]]]
        candidate = ids[first] < ids[later]
        later, first, where = later[candidate], first[candidate], group[same][candidate]

        def content(k: int) -> bytes:
            return self.texts[text[k]][s[k] : e[k]]

        equal = np.fromiter(
            (content(a) == content(b) for a, b in zip(later.tolist(), first.tolist())), bool, len(later)
        )
        found = later[equal]
        if not equal.all():
            # Unequal windows under one hash: such groups are settled by their words.
            extra = []
            for g in np.unique(where[~equal]).tolist():
                smallest: dict[bytes, int] = {}
                stop = leads[g + 1] if g + 1 < len(leads) else len(order)
                for k in order[leads[g] : stop].tolist():
                    if smallest.setdefault(content(k), ids[k]) < ids[k]:
                        extra.append(k)
            found = np.unique(np.concatenate([found, np.array(extra, np.int64)]))
        found = found[np.lexsort((at[found], prints[found], ids[found]))]
        i, p, a = ids[found], prints[found], at[found]
        # Windows that follow each other become one range.
        fresh = np.concatenate([[True], (i[1:] != i[:-1]) | (p[1:] != p[:-1]) | (a[1:] > a[:-1] + 1)])
        heads = np.flatnonzero(fresh)
        tails = np.append(heads[1:], len(found)) - 1
        return [i[heads], p[heads], a[heads], a[tails] + WINDOW] if len(found) else [i, p, a, a]


def repeated_ranges(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Word ranges to remove: doc_id, print (hash of the text), start, stop; ranges may overlap."""
    tasks = 2 * shuffle_partitions(docs.sparkSession)
    packed = super_kmers(docs, buckets or 2 * tasks)
    names = ["doc_id", "print", "start", "stop"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        current, bucket = None, _Bucket()
        for batch in batches:
            for row in batch.to_pylist():
                if row["settled"] is not None:
                    columns = np.frombuffer(open_(row["settled"]), np.int64).reshape(4, -1)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
                    continue
                if row["bucket"] != current and bucket.parts:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in bucket.ranges()], names)
                    bucket = _Bucket()
                current = row["bucket"]
                bucket.add(row["strings"], row["entries"])
        if bucket.parts:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in bucket.ranges()], names)

    dealt = packed.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    return in_arrow(dealt, run, "doc_id bigint, print bigint, start bigint, stop bigint")


def kept_words(words: list[bytes], ranges: list[tuple[int, int]]) -> list[bytes]:
    if not ranges:
        return words
    steps = np.zeros(len(words) + 1, np.int64)
    bounds = np.array(ranges, np.int64)
    np.add.at(steps, bounds[:, 0], 1)
    np.add.at(steps, bounds[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def _text_prints(docs: DataFrame) -> DataFrame:
    """doc_id, text and the hash of the text that tells rows with one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [
                None if not t.is_valid else xxhash.xxh3_64_intdigest(t.as_py().encode("utf-8", "surrogatepass")) - (1 << 63)
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(prints, pa.int64())], ["doc_id", "text", "print"]
            )

    return in_arrow(
        docs.selectExpr("cast(doc_id as bigint) doc_id", "text"),
        run,
        "doc_id bigint, text string, print bigint",
    )


def without_repeats(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Every document with the words that stay: doc_id, n_words, n_removed, kept (text)."""
    ranges = (
        repeated_ranges(docs, buckets)
        .groupBy("doc_id", "print")
        .agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
        .select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), "ranges")
    )
    rows = _text_prints(docs)
    joined = rows.join(
        ranges, (F.col("doc_id") == F.col("_id")) & (F.col("print") == F.col("_print")), "left"
    ).select("doc_id", "text", "ranges.start", "ranges.stop")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts = [], [], []
            columns = (batch.column(n) for n in ("text", "start", "stop"))
            for text, start, stop in zip(*columns):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                bounds = list(zip(start.as_py(), stop.as_py())) if start.is_valid else []
                kept = kept_words(words, bounds)
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return in_arrow(joined, run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def dedup_report(docs: DataFrame) -> DataFrame:
    """Contract rows: doc_id, n_words, n_removed, kept_sha256."""
    return without_repeats(docs).select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"),
    )
