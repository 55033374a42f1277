"""SimHash near-dedup with a binary-trie self-join.

A text's fingerprint has a bit where more than half of its shingle hashes have it. Two fingerprints
link at `budget` or fewer differing bits. Copies share a fingerprint, so the join runs on distinct
fingerprints only.

The join walks a binary trie of fingerprints against itself: a pair of nodes leads to the pairs of
their children, errors add up on unequal branches, and a pair beyond the budget is dropped with all
below it. To spread the trie over tasks its top levels are cut off: the bits are split into one block
more than the budget, so two linked fingerprints agree in at least one block, and for each block the
bits are rotated until that block comes first. Below each value of the block hangs a trie of its own,
walked from its root by one task; all tries of a task are walked together, level by level, on arrays.
A task returns a spanning forest of the links that it finds, at most one link per fingerprint, so that
a group of near copies never yields all its pairs. Linked groups come from connected components.

Defined results: a null text counts as empty; texts without words have the fingerprint zero and link
like any other; fewer words than a shingle make one shingle; rows with a null doc_id link too, but a
group's id is its smallest doc_id that is not null; repeated rows are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.columns import shuffle_partitions
from orderloom.llm.components import components
from orderloom.llm.workers import in_arrow
from orderloom.sources.staging import stage

WORDS = 4
BUDGET = 4
BITS = 64

# Node pairs are walked so many at a time, the deepest first; leaves of so few pairs are compared.
FRONTIER = 1 << 18
LEAF_PAIRS = 32
_HASHED_AT_ONCE = 1 << 16

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, width: int = WORDS) -> int:
    """SimHash of the shingles of `width` words (XXH64, seed 42), ASCII letters in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    count = max(1, len(words) - width + 1)
    stops = ends[width - 1 :] if len(words) >= width else ends[-1:]
    code = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, _HASHED_AT_ONCE):
        spans = zip(starts[at : at + _HASHED_AT_ONCE].tolist(), stops[at : at + _HASHED_AT_ONCE].tolist())
        hashes = np.array([code(joined[s:e], 42) for s, e in spans], ">u8")
        # Packed bit rows are summed by counting, 255 rows fit a byte.
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > count)
    return int.from_bytes(majority.tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """doc_id and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array(
                [fingerprint(t.as_py(), width) for t in batch.column("text")], np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(codes.view(np.int64))], ["doc_id", "code"]
            )

    return in_arrow(
        docs.selectExpr("cast(doc_id as bigint) doc_id", "text"),
        run, "doc_id bigint, code bigint"
    )


def block_bits(budget: int) -> list[tuple[int, int]]:
    """(first bit from the top, number of bits) of the budget + 1 blocks."""
    edges = [BITS * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _rotate(codes: np.ndarray, by: int) -> np.ndarray:
    if by % BITS == 0:
        return codes
    return (codes << np.uint64(by)) | (codes >> np.uint64(BITS - by))


class _Forest:
    """Union-find over the places of one sorted array of codes."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        root = self.parent[nodes]
        while True:
            above = self.parent[root]
            if np.array_equal(above, root):
                return root
            root = above

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        """Join by smaller root until no pair is apart."""
        while left.size:
            a, b = self.roots(left), self.roots(right)
            apart = a != b
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
        every = self.roots(np.arange(len(self.parent)))
        self.parent = every


def trie_links(codes: np.ndarray, top: int, budget: int) -> np.ndarray:
    """Root place of each code among those linked with it, for sorted distinct `codes`.

    Codes link within the same value of their first `top` bits. A trie node is a range of the sorted
    codes with a common prefix. Node pairs whose codes are all in one group already are dropped.
    """
    forest = _Forest(len(codes))
    if len(codes) < 2:
        return forest.parent
    tops = codes >> np.uint64(BITS - top)
    starts = np.flatnonzero(np.concatenate([[True], tops[1:] != tops[:-1]]))
    stops = np.append(starts[1:], len(codes))
    several = stops - starts > 1
    starts, stops = starts[several], stops[several]
    stack = [
        (top, starts[i : i + FRONTIER], stops[i : i + FRONTIER], starts[i : i + FRONTIER], stops[i : i + FRONTIER])
        for i in range(0, len(starts), FRONTIER)
    ]
    while stack:
        depth, a0, a1, b0, b1 = stack.pop()
        small = ((a1 - a0) * (b1 - b0) <= LEAF_PAIRS) | (depth >= BITS)
        if small.any():
            _compare_leaves(codes, forest, budget, a0[small], a1[small], b0[small], b1[small])
            a0, a1, b0, b1 = a0[~small], a1[~small], b0[~small], b1[~small]
        if not a0.size:
            continue
        bit = np.uint64(BITS - 1 - depth)
        am, bm = _middle(codes, a0, a1, bit), _middle(codes, b0, b1, bit)
        same = a0 == b0
        children = [
            (a0, am, b0, bm, None),
            (am, a1, bm, b1, None),
            (a0, am, bm, b1, None),
            (am, a1, b0, bm, ~same),
        ]
        left = [np.concatenate([c[k] if c[4] is None else c[k][c[4]] for c in children]) for k in range(4)]
        full = (left[1] > left[0]) & (left[3] > left[2])
        l0, l1, r0, r1 = (x[full] for x in left)
        # A lone code facing itself has nothing to link.
        lone = (l0 == r0) & (l1 - l0 == 1)
        l0, l1, r0, r1 = l0[~lone], l1[~lone], r0[~lone], r1[~lone]
        shift = np.uint64(BITS - 1 - depth)
        errors = np.bitwise_count((codes[l0] ^ codes[r0]) >> shift)
        alive = errors <= budget
        l0, l1, r0, r1 = l0[alive], l1[alive], r0[alive], r1[alive]
        # All codes of both nodes in one group: nothing new below.
        large = (l1 - l0) * (r1 - r0) > 4 * LEAF_PAIRS
        if large.any():
            done = np.zeros(len(l0), bool)
            done[large] = _one_group(forest, l0[large], l1[large], r0[large], r1[large])
            l0, l1, r0, r1 = l0[~done], l1[~done], r0[~done], r1[~done]
        for i in range(0, len(l0), FRONTIER):
            s = slice(i, i + FRONTIER)
            stack.append((depth + 1, l0[s], l1[s], r0[s], r1[s]))
    return forest.roots(np.arange(len(codes)))


def _middle(codes: np.ndarray, start: np.ndarray, stop: np.ndarray, bit: np.uint64) -> np.ndarray:
    """Place of the first code of each node that has the bit."""
    prefix = codes[start] >> bit | np.uint64(1)
    return np.clip(np.searchsorted(codes, prefix << bit), start, stop)


def _one_group(forest: _Forest, a0, a1, b0, b1) -> np.ndarray:
    """Whether all codes of both nodes have one root: no change of root inside either range."""
    roots = forest.parent
    changes = np.concatenate([[0], np.cumsum(roots[1:] != roots[:-1])])
    return (
        (changes[a1 - 1] == changes[a0]) & (changes[b1 - 1] == changes[b0]) & (roots[a0] == roots[b0])
    )


def _compare_leaves(codes, forest, budget, a0, a1, b0, b1) -> None:
    """Link the codes of small node pairs that differ in few enough bits."""
    widths = b1 - b0
    sizes = (a1 - a0) * widths
    step = 1 << 20
    ends = np.cumsum(sizes)
    for low in range(0, int(ends[-1]), step):
        flat = np.arange(low, min(low + step, int(ends[-1])))
        pair = np.searchsorted(ends, flat, "right")
        inside = flat - (ends[pair] - sizes[pair])
        left, right = a0[pair] + inside // widths[pair], b0[pair] + inside % widths[pair]
        near = (left != right) & (np.bitwise_count(codes[left] ^ codes[right]) <= budget)
        if near.any():
            forest.link(left[near], right[near])


def near_links(codes: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs within the budget.

    `codes` has one column of distinct longs. Each code travels once per block.
    """
    blocks = block_bits(budget)
    (column,) = codes.columns
    spread = codes.select(
        F.explode(F.array(*[F.lit(n) for n in range(len(blocks))])).alias("block"), F.col(column).alias("code")
    )
    value = F.lit(None).cast("long")
    for n, (first, size) in enumerate(blocks):
        cut = F.shiftrightunsigned(F.shiftleft("code", first), BITS - size)
        value = F.when(F.col("block") == n, cut).otherwise(value)
    dealt = spread.withColumn("value", value).repartition(
        2 * shuffle_partitions(codes.sparkSession), "block", "value"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, code = [], []
        for batch in batches:
            block.append(batch.column("block").to_numpy())
            code.append(batch.column("code").to_numpy().view(np.uint64))
        if not block:
            return
        block, code = np.concatenate(block), np.concatenate(code)
        for n, (first, size) in enumerate(blocks):
            turned = np.sort(_rotate(code[block == n], first))
            roots = trie_links(turned, size, budget)
            back = _rotate(turned, BITS - first).view(np.int64)
            linked = roots != np.arange(len(roots))
            yield pa.RecordBatch.from_arrays(
                [pa.array(back[linked]), pa.array(back[roots[linked]])], ["a", "b"]
            )

    return in_arrow(dealt.select("block", "code"), run, "a bigint, b bigint")


def near_groups(docs: DataFrame, width: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """doc_id, code and component_id (the smallest doc_id reachable), one row per document."""
    coded = stage(fingerprints(docs, width), "fingerprints")
    classes = coded.groupBy("code").agg(F.min("doc_id").alias("least"))
    joined = components(near_links(classes.select("code"), budget))
    known = classes.join(joined, F.col("code") == F.col("node"), "left").select(
        "code", "least", F.coalesce("root", "code").alias("root")
    )
    known = stage(known, "fingerprint-classes")
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = known.join(smallest, "root").select("code", "component_id")
    return coded.join(named, "code").select("doc_id", "code", "component_id")


def group_documents(docs: DataFrame) -> DataFrame:
    """Contract rows: doc_id, fingerprint, component_id."""
    found = near_groups(docs)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_each(docs: DataFrame, width: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """The documents that represent their group: those with its smallest doc_id.

    Documents without a doc_id cannot be told apart and all stay; rows that repeat a doc_id stay or go
    together.
    """
    groups = near_groups(docs, width, budget)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = docs.select(*columns)
    unnamed = rows.where(F.col("doc_id").isNull())
    return rows.join(kept, "doc_id", "left_semi").unionByName(unnamed)
