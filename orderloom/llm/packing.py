"""Best-fit packing of token pieces into sequences.

Documents become pieces of at most `capacity` tokens (only longer documents are cut; the short piece
comes first). Best fit puts each piece, longest first, into the open sequence with the least room that
still holds it. It runs bulk-synchronously on sorted runs: lengths and rooms are whole numbers up to
the capacity, so all pieces of one length form a run and all sequences with one room form runs. A
sweep takes the longest unplaced run, finds the successor run among the rooms, matches the two by rank
(the n-th piece goes where rank n falls), updates the rooms, and goes on with the next successor; what
no room holds opens new sequences. The result is that of one-by-one best fit.

Spark cuts and counts pieces, numbers them within their length, and places every piece by its rank.
The plan between these steps sees one number per length (at most `capacity`), whatever the corpus.

Defined results: a null or empty text is one piece with the end mark alone; repeated rows are packed
one by one; equal lengths are ranked by where they are stored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.bpe import encoder_of, large, share_vocabulary
from orderloom.llm.workers import in_arrow
from orderloom.sources.staging import stage

CAPACITY = 1024
END_MARK = 2


@dataclass(frozen=True)
class Placement:
    """Pieces `first` .. `first + count - 1` of a length, `per` to a sequence.

    The piece with rank r goes to sequence `sequence + (r - first) // per`, at place
    `offset + (r - first) % per * length`.
    """

    length: int
    first: int
    count: int
    per: int
    sequence: int
    offset: int


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Placement], int]:
    """Placements for `counts` pieces of each length, and the number of sequences."""
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> runs of (first sequence, how many)
    sizes: list[int] = []  # the rooms in ascending order
    placed: list[Placement] = []
    opened = 0

    def leave(room: int, sequence: int, many: int) -> None:
        if room and many:
            if room not in rooms:
                insort(sizes, room)
                rooms[room] = []
            rooms[room].append((sequence, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def fill(room: int, sequence: int, many: int) -> None:
            """Put what is left into `many` equal sequences, each filled before the next."""
            nonlocal rank, left
            per = room // length
            full = min(many, left // per)
            if full:
                placed.append(Placement(length, rank, full * per, per, sequence, capacity - room))
                leave(room - per * length, sequence, full)
                rank, left = rank + full * per, left - full * per
            if left and full < many:
                placed.append(Placement(length, rank, left, left, sequence + full, capacity - room))
                leave(room - left * length, sequence + full, 1)
                rank, left, full = rank + left, 0, full + 1
            leave(room, sequence + full, many - full)

        at = bisect_left(sizes, length)
        while left and at < len(sizes):
            room = sizes.pop(at)
            for sequence, many in rooms.pop(room):
                if left:
                    fill(room, sequence, many)
                else:
                    leave(room, sequence, many)
            # A partly filled sequence may still have room for this length, a smaller one than before.
            at = bisect_left(sizes, length)
        if left:
            need = -(-left // (capacity // length))
            first, opened = opened, opened + need
            fill(capacity, first, need)
    return placed, opened


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
               end_mark: int = END_MARK) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, part, rank.

    `rank` counts the pieces of the same length in the same task, `part`.
    """
    shared = share_vocabulary(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(large(batch.column("text")))):
                ids = np.append(ids, np.uint32(end_mark)).astype("<u4")
                start, stop = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while start < len(ids):
                    size = stop - start
                    code = zlib.crc32(ids[start:stop].tobytes())
                    rows.append((doc, piece, start, size, code, part, seen[size]))
                    seen[size] += 1
                    start, stop, piece = stop, stop + capacity, piece + 1
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)], names
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    return in_arrow(
        docs.selectExpr("cast(doc_id as bigint) doc_id", "text"),
        run,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint",
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Contract rows: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    pieces = stage(cut_pieces(docs, capacity, vocabulary), "pieces")
    sizes = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row per length: at most `capacity` rows.
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placements, _ = best_fit_plan(counts, capacity)
    columns = np.array(
        [(p.length, p.first, p.per, p.sequence, p.offset) for p in placements], np.int64
    ).reshape(-1, 5)
    columns = columns[np.lexsort((columns[:, 1], columns[:, 0]))]
    # The plan has a row for each pair of runs that met; it is bounded by the capacity's square.
    shared = spark.sparkContext.broadcast(columns.tobytes())

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(firsts, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = np.frombuffer(shared.value, np.int64).reshape(-1, 5)
        widest = 1 << 44  # more ranks than a length can have
        keys = plan[:, 0] * widest + plan[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = plan[np.searchsorted(keys, length * widest + rank, "right") - 1] if len(rank) else plan[:0]
            beyond = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(row[:, 3] + beyond // row[:, 2]),
                    pa.array(row[:, 4] + beyond % row[:, 2] * length),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return in_arrow(
        ranked,
        place,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
    )
