"""Byte-level BPE by speculate and verify.

For every distinct word, greedy longest match proposes tokens. The proposal is BPE's own answer if and
only if no adjacent pair of tokens could have merged across its border before the merges that built
the two; that check runs over the pairs of all words at once. Words with a failing pair, and only
those, are merged exactly, lowest rank first.

Texts are cut before every single space that a non-blank character follows: no token reaches across
such a place, and what lies between repeats often enough to be encoded once per task.

Defined results: a null text counts as empty and has no tokens; added tokens in a text (such as an end
mark) become their ids; ids decode to the text's own bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from orderloom.llm.workers import in_arrow, keep_one

# Fixed value: the pre-tokenizer's pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Work is done on about so many characters at once, and so many pieces are remembered per task.
SLICE_CHARS = 8_000_000
REMEMBERED = 1_000_000

_FAR = np.int64(1) << 40


def _byte_letters() -> dict[str, int]:
    """The vocabulary's letter for each byte: printable Latin-1 as itself, others from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


# A letter or digit and a comma or full stop never share a token; the character that marks such
# borders must not be in the text, else the pattern itself cuts it.
_CUT = "\x00"
_BORDERS = r"([\p{L}\p{N}])([.,])"
_CUT_BORDERS = "\\1\x00\\2"


def _parts(texts: pa.Array, separator: str) -> tuple[pa.Array, np.ndarray]:
    """All parts between separators, and their number for each text."""
    cut = pc.split_pattern(texts, separator)
    return cut.flatten(), pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


class Vocabulary:
    """Tokens by rank: the 256 bytes first, then every merge in its order."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        letters = _byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        names: list[str] = list(letters)
        rank_of = {name: i for i, name in enumerate(names)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right = [0] * 256, [0] * 256
        for first, second in merges:
            name = first + second
            if name in rank_of:
                raise ValueError(f"two merges make the token {name!r}")
            left.append(rank_of[first])
            right.append(rank_of[second])
            rank_of[name] = len(names)
            names.append(name)
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)
        self.count = len(names)
        self.bytes = [bytes(letters[c] for c in name) for name in names]
        self.ids = np.array([vocab[name] for name in names], np.uint32)
        keys = self.left[256:] * self.count + self.right[256:]
        order = np.argsort(keys)
        self._keys, self._made = keys[order], order + 256
        self.merged = dict(zip(keys.tolist(), range(256, self.count)))
        self.byte_rank = {bytes([b]): rank_of[c] for c, b in letters.items()}
        # A token that BPE splits when it stands alone must not be proposed.
        sound = np.ones(self.count, bool)
        inner = np.arange(256, self.count)
        sound[256:] = self.compatible(self.left[256:], self.right[256:], inner)
        for rank in range(256, self.count):
            sound[rank] &= sound[left[rank]] and sound[right[rank]]
        self.table = {self.bytes[r]: r for r in range(self.count) if sound[r]}
        # Greatest length of the tokens with the same first four bytes.
        self.longest: dict[bytes, int] = {}
        for token in self.table:
            if len(token) > 3:
                self.longest[token[:4]] = max(self.longest.get(token[:4], 4), len(token))
        self._decode_tables()

    def _decode_tables(self) -> None:
        highest = max([int(self.ids.max()), *self.added.values()])
        content = [b""] * (highest + 1)
        for rank, token in enumerate(self.bytes):
            content[int(self.ids[rank])] = token
        for text, number in self.added.items():
            content[number] = text.encode()
        self._flat = np.frombuffer(b"".join(content), np.uint8)
        self._len = np.array([len(c) for c in content], np.int64)
        self._at = np.cumsum(self._len) - self._len

    def _merge_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = first * self.count + second
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._made[at], _FAR)

    def compatible(self, first: np.ndarray, second: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair of neighbours stays apart.

        The merges behind both tokens are undone, latest first. Had the two parts that then meet at
        the border a merge of lower rank than all that were undone, BPE would have made it instead.
        """
        apart = np.ones(len(first), bool)
        live = np.arange(len(first))
        a, b = first.astype(np.int64), second.astype(np.int64)
        bound = np.full(len(a), _FAR) if limit is None else limit.astype(np.int64)
        while live.size:
            across = self._merge_of(a, b) < bound
            apart[live[across]] = False
            on = ~across & ~((a < 256) & (b < 256))
            live, a, b = live[on], a[on], b[on]
            undo_first = a > b
            bound = np.where(undo_first, a, b + 1)
            a, b = np.where(undo_first, self.right[a], a), np.where(undo_first, b, self.left[b])
        return apart

    def proposal(self, word: bytes) -> list[int]:
        """Ranks by greedy longest match."""
        table, longest, byte_rank = self.table, self.longest, self.byte_rank
        found, at, end = [], 0, len(word)
        while at < end:
            for stop in range(min(end, at + longest.get(word[at : at + 4], 3)), at + 1, -1):
                rank = table.get(word[at:stop])
                if rank is not None:
                    break
            else:
                stop, rank = at + 1, byte_rank[word[at : at + 1]]
            found.append(rank)
            at = stop
        return found

    def exact(self, word: bytes) -> list[int]:
        """Ranks by merging the pair of lowest rank, leftmost first, until none merges."""
        ranks = [self.byte_rank[word[i : i + 1]] for i in range(len(word))]
        return self._merge_few(ranks) if len(ranks) <= 64 else self._merge_many(ranks)

    def _merge_few(self, ranks: list[int]) -> list[int]:
        """The lowest of all pairs is looked up anew after each merge."""
        count, made_of, none = self.count, self.merged.get, int(_FAR)
        made = [made_of(a * count + b, none) for a, b in zip(ranks, ranks[1:])]
        while made:
            least = min(made)
            if least == none:
                break
            i = made.index(least)
            ranks[i : i + 2] = [least]
            del made[i]
            if i:
                made[i - 1] = made_of(ranks[i - 1] * count + least, none)
            if i < len(made):
                made[i] = made_of(least * count + ranks[i + 1], none)
        return ranks

    def _merge_many(self, ranks: list[int]) -> list[int]:
        """The lowest pair comes from a heap, neighbours from links: n log n for any length."""
        count, made_of, end = self.count, self.merged.get, len(ranks)
        after = list(range(1, end + 1))
        before = list(range(-1, end - 1))
        pairs = enumerate(zip(ranks, ranks[1:]))
        heap = [(m, i) for i, (a, b) in pairs if (m := made_of(a * count + b)) is not None]
        heapq.heapify(heap)
        while heap:
            made, i = heapq.heappop(heap)
            j = after[i]
            if ranks[i] < 0 or j >= end or made_of(ranks[i] * count + ranks[j]) != made:
                continue
            ranks[i], ranks[j] = made, -1
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            for a, b in ((i, after[i]), (before[i], i)):
                if a >= 0 and b < end and (m := made_of(ranks[a] * count + ranks[b])) is not None:
                    heapq.heappush(heap, (m, a))
        return [r for r in ranks if r >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of all words, one after the other, and their number for each word."""
        proposals = [self.proposal(word) for word in words]
        lengths = np.fromiter(map(len, proposals), np.int64, len(words))
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(lengths.sum()))
        if len(flat) < 2:
            return flat, lengths
        word_of = np.repeat(np.arange(len(words)), lengths)
        inside = np.flatnonzero(word_of[1:] == word_of[:-1])
        pairs, back = np.unique(flat[inside] * self.count + flat[inside + 1], return_inverse=True)
        apart = self.compatible(pairs // self.count, pairs % self.count)[back]
        failing = np.unique(word_of[inside[~apart]])
        if failing.size:
            for w in failing.tolist():
                proposals[w] = self.exact(words[w])
            lengths = np.fromiter(map(len, proposals), np.int64, len(words))
            flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(lengths.sum()))
        return flat, lengths

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        return self._flat[ragged(self._at[ids], self._len[ids])].tobytes()


class Encoder:
    """A vocabulary with the pieces that this task has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._split = regex.compile(PATTERN).findall
        self._added = (
            regex.compile("|".join(map(regex.escape, sorted(vocabulary.added, key=len, reverse=True))))
            if vocabulary.added
            else None
        )
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, dict[str, int]] = {"": {}, " ": {}}
        self._ids = np.zeros(0, np.uint32)
        self._len = np.zeros(0, np.int64)

    def _numbers(self, pieces: list[str], lead: str = "") -> np.ndarray:
        """Place in the store of each piece after `lead`; unknown ones are encoded together."""
        known = self._known[lead]
        places = [known.get(piece, -1) for piece in pieces]
        new = list(dict.fromkeys(p for p, place in zip(pieces, places) if place < 0))
        if not new:
            return np.array(places, np.int64)
        split = self._split
        words = [[lead + p] if p.isalpha() else split(lead + p) for p in new]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        every = [w.encode("utf-8", "surrogatepass") for w in chain.from_iterable(words)]
        ranks, lengths = self.vocabulary.encode_words(every)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        word_ends = np.concatenate([[0], np.cumsum(counts)])
        number = len(self._len)
        self._ids = np.concatenate([self._ids, self.vocabulary.ids[ranks]])
        self._len = np.concatenate([self._len, np.diff(ends[word_ends])])
        known.update(zip(new, range(number, number + len(new))))
        return np.array([known[p] if q < 0 else q for p, q in zip(pieces, places)], np.int64)

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without added tokens and their number for each text."""
        if len(self._len) > REMEMBERED:
            self._forget()
        marked = pc.match_substring(texts, _CUT).to_numpy(zero_copy_only=False)
        sections, section_counts = _parts(pc.replace_substring_regex(texts, _BORDERS, _CUT_BORDERS), _CUT)
        flat, section_sizes = _parts(sections, " ")
        counts = np.add.reduceat(section_sizes, np.cumsum(section_counts) - section_counts) if len(texts) else section_sizes
        first = np.zeros(len(flat), bool)
        first[np.cumsum(section_sizes) - section_sizes] = True
        coded = flat.dictionary_encode()
        values = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # A blank after a space moves the border: such texts are cut by the pattern itself.
        loose = np.array([not v or v[0].isspace() for v in values], bool)[codes] & ~first
        text_of = np.repeat(np.arange(len(counts)), counts)
        odd = marked.copy()
        odd[text_of[loose]] = True
        pieces = np.empty(len(flat), np.int64)
        spaced = ~first & ~odd[text_of]
        for chosen, lead in ((first & ~odd[text_of], ""), (spaced, " ")):
            used = np.unique(codes[chosen])
            place = np.zeros(len(values), np.int64)
            place[used] = self._numbers([values[i] for i in used.tolist()], lead)
            pieces[chosen] = place[codes[chosen]]
        if odd.any():
            split = {int(t): self._numbers(self._split(texts[int(t)].as_py())) for t in np.flatnonzero(odd)}
            parts = np.split(pieces, np.cumsum(counts)[:-1])
            parts = [split.get(t, part) for t, part in enumerate(parts)]
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            pieces = np.concatenate(parts)
            text_of = np.repeat(np.arange(len(counts)), counts)
        lengths = self._len[pieces]
        starts = np.cumsum(self._len) - self._len
        ids = self._ids[ragged(starts[pieces], lengths)]
        return ids, np.bincount(text_of, lengths, len(counts)).astype(np.int64)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        texts = pc.fill_null(texts, "")
        chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(chars) // SLICE_CHARS
        borders = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        for start, stop in zip(borders, borders[1:]):
            if stop > start:
                yield from self._slice(texts.slice(start, stop - start))

    def _slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        marked = [
            t
            for t in range(len(texts))
            if self._added and any(mark in texts[t].as_py() for mark in self.vocabulary.added)
        ] if any(pc.any(pc.match_substring(texts, m)).as_py() for m in self.vocabulary.added) else []
        ids, counts = self._plain(texts)
        ends = np.cumsum(counts)
        special = {t: self._with_added(texts[t].as_py()) for t in marked}
        for t in range(len(texts)):
            yield special[t] if t in special else ids[ends[t] - counts[t] : ends[t]]

    def _with_added(self, text: str) -> np.ndarray:
        parts, at = [], 0
        for mark in self._added.finditer(text):
            parts += [self._one(text[at : mark.start()]), [self.vocabulary.added[mark.group()]]]
            at = mark.end()
        return np.concatenate([*parts, self._one(text[at:])]).astype(np.uint32)

    def _one(self, text: str) -> np.ndarray:
        return self._plain(pa.array([text], pa.large_string()))[0]


def default_vocabulary() -> str:
    """Path of the public 50k byte-level vocabulary, where it is installed."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def share_vocabulary(spark: SparkSession, path: str | None = None):
    """Broadcast the vocabulary file (under two megabytes), read on the driver."""
    with open(path or default_vocabulary(), "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encoder_of(content: bytes) -> Encoder:
    """This Python worker's encoder; it keeps the last vocabulary only."""
    key = hashlib.sha256(content).hexdigest()
    return keep_one(("encoder", key), lambda: Encoder(Vocabulary(content)))


def large(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.cast(pa.large_string())


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Token ids of every text: doc_id, ids (array of int)."""
    shared = share_vocabulary(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            ids = [i.astype(np.int32) for i in encoder.encode(large(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return in_arrow(
        docs.selectExpr("cast(doc_id as bigint) doc_id", "text"),
        run, "doc_id bigint, ids array<int>"
    )


def decode_ids(rows: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Texts of token ids: columns doc_id and ids become doc_id and text."""
    shared = share_vocabulary(rows.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder_of(shared.value).vocabulary.decode
        for batch in batches:
            texts = [
                decode(np.array(ids or [], np.uint32)).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return in_arrow(rows.select("doc_id", "ids"), run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Contract rows: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    shared = share_vocabulary(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            counts, ids_hash, text_hash = [], [], []
            for ids in encoder.encode(large(batch.column("text"))):
                decoded = encoder.vocabulary.decode(ids).decode("utf-8", "replace").encode()
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_hash.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_hash, pa.string()),
                    pa.array(text_hash, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return in_arrow(
        docs.selectExpr("cast(doc_id as bigint) doc_id", "text"),
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
