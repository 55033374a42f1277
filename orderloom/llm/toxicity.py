"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel counts the common subsequences of ORDER characters of two strings, each weighted by DECAY
to the length that it spans, so that gaps and inserted characters weaken a match but do not break it.
It compares a text's units (words without the punctuation round them, and runs of single characters
joined) and its windows (neighbouring units with their spaces, and their letters without any: all
pairs, and all longer ones of at most LONGEST characters) with a few landmark strings; the landmarks'
own kernel matrix turns these values into coordinates in which a linear support vector machine is the
kernel machine (Nystroem).

Labels belong to whole documents, so the machine is trained with a latent witness: a document scores
as its highest unit or window. In turns the highest one of each toxic document becomes a positive
example and the machine is fitted to it against those of clean documents, the highest ones above all.
A window is a witness if toxic documents have it too often for chance, and its words don't tell more.
Some positive examples are repeated with inserted characters or spaces. Scores become probabilities by
a sigmoid fitted to the training documents.

The training sample is bounded: PER_CLASS documents of each label, in the order of their ids' hashes.
Scoring covers all texts in full. A unit's or window's value is first bounded from sums known of its
words, which are kept from text to text; bounds become closer in steps, and only units and windows whose
bound is above the text's best value are compared in full, so that the highest value is always found.

Defined results: null and empty texts get the score of a text without any unit, which is low; null
labels and labels of unknown documents are not learned from; without both labels every score is 0;
repeated label rows count once.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.workers import in_arrow, keep_one

ORDER = 3
DECAY = 0.7
LANDMARKS = 36
PER_CLASS = 1_000
ROUNDS = 4
RIDGE = 0.003
LIMIT = 0.3

# Longer units are cut into pieces that overlap by half.
LONGEST = 24
_START = "\x02"
_AT_ONCE = 128
_TOGETHER = 1_024
_REMEMBERED = 300_000
_KEPT = 100_000
_SLICE_CHARS = 2_000_000
# Digits of a text's margin that do not depend on the texts beside it.
_DIGITS = 6
_ROUND = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„’‘…–—¿¡"
# One in so many windows of clean documents is an example from the start; their highest ones follow.
_NEGATIVES = 64


def units_of(words: list[str]) -> list[str]:
    """Units of a list of lower-case words: each word bare, and single characters in a row joined."""
    bare = [w.strip(_ROUND) for w in words]
    joined, run = [], []
    for w in [*bare, ""]:
        if len(w) == 1:
            run.append(w)
        else:
            if len(run) > 2:
                joined.append("".join(run))
            run = []
    return [w for w in bare if w] + joined


def windows_of(bare: list[str]) -> list[str]:
    """All pairs of neighbouring units, and all longer windows of at most LONGEST characters."""
    found = []
    for i in range(len(bare) - 1):
        window = f"{bare[i][-LONGEST:]} {bare[i + 1][:LONGEST]}"
        found.append(window)
        for j in range(i + 2, len(bare)):
            if len(window) + 1 + len(bare[j]) > LONGEST:
                break
            window = f"{window} {bare[j]}"
            found.append(window)
    return found


def _letters(unit: str) -> str:
    return unit if unit.isalpha() else "".join(filter(str.isalpha, unit))


def _parts(string: str) -> list[str]:
    """A string marked at its start, or parts of it that overlap by half and leave out nothing."""
    half = LONGEST // 2
    later = range(half, len(string) - half, half) if len(string) > LONGEST else ()
    return [_START + string[:LONGEST], *[string[i : i + LONGEST] for i in later]]


def _pieces(unit: str) -> list[str]:
    """What a unit is compared by: itself or its parts, and its letters alone if it has other signs."""
    letters = _letters(unit)
    if " " in unit:
        return [_START + unit, *([_START + letters] if len(letters) >= ORDER else [])]
    return _parts(unit) + (_parts(letters) if letters != unit and len(letters) >= ORDER else [])


def _codes(strings: list[str], width: int, empty: int, right: bool = False) -> np.ndarray:
    """(strings, width): code points, `empty` behind each string or, if `right`, in front of it."""
    found = np.full((len(strings), width), empty, np.int32)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))[:, None]
    places = np.arange(width)
    flat = "".join(strings).encode("utf-32-le", "surrogatepass")
    found[places >= width - sizes if right else places < sizes] = np.frombuffer(flat, np.int32)
    return found


def _kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Subsequence kernel of strings given as codes, the last axis being units.

    left: (T, N). right: (..., L, N) or (..., L, 1). Equal codes match, other pads differ.

    A common subsequence weighs DECAY to the length of its span in either string. Sums over all that
    start earlier are kept as if every span began at the strings' starts, so that a start costs
    DECAY to minus its places and an end DECAY to its places; between them only sums are left.
    """
    shape = np.broadcast_shapes(right.shape, (*right.shape[:-1], left.shape[1]))
    chains = [np.zeros(shape, np.float32) for _ in range(ORDER - 1)]
    total = np.zeros((*shape[:-2], shape[-1]), np.float32)
    places = np.float32(DECAY) ** np.arange(shape[-2], dtype=np.float32)[:, None]
    for a, codes in enumerate(left):
        match = (right == codes).astype(np.float32)
        decay = np.float32(DECAY) ** np.float32(a)
        # chains[i][b]: weight of the subsequences of i + 1 characters before a and before b.
        total += (match * chains[-1] * (places * (decay * DECAY * DECAY))).sum(axis=-2)
        for i in range(ORDER - 2, -1, -1):
            new = match * (chains[i - 1] if i else 1 / (places * decay))
            chains[i][..., 1:, :] += np.cumsum(new[..., :-1, :], axis=-2)
    return total


class Landmarks:
    """Landmark strings and the map of strings into their kernel space."""

    def __init__(self, strings: list[str]):
        self.strings = strings
        # Landmarks of like length share an array, so that short ones aren't padded to the longest.
        order = np.argsort([len(s) for s in strings], kind="stable")
        self._groups = []
        for some in np.array_split(order, min(3, len(order))):
            part = [strings[k] for k in some.tolist()]
            self._groups.append((some, _codes(part, max(map(len, part)), -2)[:, :, None]))
        self.own = _self_kernel(strings)
        matrix = self._normal(strings)
        values, vectors = np.linalg.eigh(matrix.astype(np.float64))
        kept = values > 1e-4
        self.map = (vectors[:, kept] / np.sqrt(values[kept])).astype(np.float32)

    def _normal(self, strings: list[str]) -> np.ndarray:
        """Normalised kernel values, (strings, landmarks)."""
        found = np.zeros((len(strings), len(self.strings)), np.float32)
        order = np.argsort([len(s) for s in strings], kind="stable")
        for at in range(0, len(order), _AT_ONCE):
            some = order[at : at + _AT_ONCE]
            part = [strings[k] for k in some.tolist()]
            # A single string would be summed in another order.
            part = part * 2 if len(part) == 1 else part
            left = np.ascontiguousarray(_codes(part, max(map(len, part)), -1).T)
            scale = np.sqrt(np.outer(self.own, _self_kernel(part)))
            with np.errstate(divide="ignore", invalid="ignore"):
                for which, codes in self._groups:
                    values = np.where(scale[which] > 0, _kernel(left, codes) / scale[which], 0)
                    found[np.ix_(some, which)] = values.T[: len(some)]
        return found

    def features(self, strings: list[str], known: dict[str, np.ndarray] | None = None) -> np.ndarray:
        """Coordinates of the strings; those in `known` are taken from there, the others added."""
        if known is None:
            return self._normal(strings) @ self.map
        new = list(dict.fromkeys(s for s in strings if s not in known))
        if new:
            known.update(zip(new, self._normal(new) @ self.map))
        return np.stack([known[s] for s in strings])

    def tensor(self, weights: np.ndarray) -> _Tensor:
        return _Tensor(self, weights)

    def weighed(self, strings: list[str], weights: np.ndarray) -> np.ndarray:
        """Features times weights, whatever else is in the list."""
        return self.tensor(weights).values(strings)


def _own(strings: list[str]) -> np.ndarray:
    """Each string's kernel with itself, 0 for those below ORDER characters."""
    found, length = np.zeros(len(strings), np.float32), np.fromiter(map(len, strings), np.int64, len(strings))
    order = np.argsort(length, kind="stable")
    order = order[length[order] >= ORDER]
    for at in range(0, len(order), _TOGETHER):
        some = order[at : at + _TOGETHER]
        found[some] = _self_kernel([strings[k] for k in some.tolist()])
    return found


def _self_kernel(strings: list[str]) -> np.ndarray:
    width = max(map(len, strings))
    left = np.ascontiguousarray(_codes(strings, width, -1).T)
    right = np.ascontiguousarray(_codes(strings, width, -2).T)
    return _kernel(left, right)


# For bounds: added to them, as they are sums in another order and precision than the kernel's.
_SLACK = 1e-3
_STARTS = 10_000
# Training documents whose windows are compared at once, for the driver's memory.
_DOCUMENTS = 50


class _Tensor:
    """A machine's weight of every subsequence of three characters that its landmarks have.

    A string's sum is DECAY to the span times this weight over all its subsequences. Divided by the
    root of its kernel with itself it is the machine's value, without a comparison with each landmark.
    """

    def __init__(self, landmarks: Landmarks, weights: np.ndarray):
        alphabet = sorted(set("".join(landmarks.strings)))
        self.place = {c: k for k, c in enumerate(alphabet)}
        self._alphabet = np.array([ord(c) for c in alphabet], np.int32)
        self.v = np.zeros((len(alphabet),) * 3)
        factors = landmarks.map.astype(np.float64) @ weights.astype(np.float64)
        for string, factor, own in zip(landmarks.strings, factors.tolist(), landmarks.own.tolist()):
            if own > 0:
                codes = np.array([self.place[c] for c in string])
                a, b, c = np.array(list(itertools.combinations(range(len(string)), 3))).T
                np.add.at(self.v, (codes[a], codes[b], codes[c]), factor / math.sqrt(own) * DECAY ** (c - a + 1.0))

    def places(self, strings: list[str], width: int, right: bool) -> np.ndarray:
        """(strings, width): each character's place in the alphabet, -1 for others and beside the string."""
        codes = _codes(strings, width, -1, right)
        found = np.minimum(np.searchsorted(self._alphabet, codes), len(self._alphabet) - 1)
        return np.where(self._alphabet[found] == codes, found, -1)

    def sums(self, strings: list[str]) -> np.ndarray:
        """Each string's sum."""
        size, v = len(self.v), self.v
        codes = self.places(strings, max(map(len, strings)), True)
        one, two = np.zeros((len(strings), size)), np.zeros((len(strings), size))
        total = np.zeros(len(strings))
        for column in codes.T:
            # Open subsequences of one character; of two, by the third to come.
            one *= DECAY
            two *= DECAY
            for c, rows in _rows(column):
                total[rows] += DECAY * two[rows, c]
                two[rows] += one[rows] @ v[:, c, :]
                one[rows, c] += 1
        return total

    def values(self, strings: list[str]) -> np.ndarray:
        """The machine's value of each string, without its offset, whatever else is in the list."""
        found = np.zeros(len(strings))
        order = np.argsort(np.fromiter(map(len, strings), np.int64, len(strings)), kind="stable")
        for at in range(0, len(order), _TOGETHER):
            some = order[at : at + _TOGETHER]
            part = [strings[k] for k in some.tolist()]
            # A single string would be summed in another order.
            part = part * 2 if len(part) == 1 else part
            own = _self_kernel(part)
            total = self.sums(part)
            found[some] = np.where(own > 0, total / np.sqrt(np.where(own > 0, own, 1)), 0)[: len(some)]
        return found


def _rows(column: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each code that is not negative."""
    order = np.argsort(column, kind="stable")
    codes, starts = np.unique(column[order], return_index=True)
    for c, rows in zip(codes.tolist(), np.split(order, starts[1:])):
        if c >= 0:
            yield c, rows


class _Units:
    """What windows need of their units, which have the character `before` or none between them.

    `left` and `right`: the product of one's `left` and the next one's `right` is the sum of the
    subsequences that both take part in; `ahead`, `third`: first and third characters of those that have
    their second one in a unit between. `marks`: for the start mark in front of a window's first unit and
    the character in front of later ones, its place, what it adds by the third character, and the unit's
    fading. `sums`: the unit's own sum behind either. `excess`: what its kernel with itself has above the
    least.
    """

    def __init__(self, tensor: _Tensor, base: tuple[np.ndarray, ...], left: np.ndarray, before: str):
        length, total, one, two, last, later, held, self.excess = base
        v, decay = tensor.v.astype(np.float32), np.float32(DECAY)
        self.left, self.size, self.bare = left, length + len(before), length
        self.ahead = left[:, len(v) :]
        self.marks, self.sums = [], []
        for mark in (_START, before):
            c = tensor.place.get(mark)
            self.sums.append(total if c is None else total + decay * later[:, c])
            self.marks.append(None if c is None else (c, held @ v[c], decay ** length.astype(np.float32)))
        # `held`: numbers of characters. `shift`: what `before` adds to the marks' sums.
        c, self.shift, self.held = tensor.place.get(before), [np.zeros(len(v), np.float32)] * 2, held
        if c is not None:
            later = later + last @ v[:, c, :].T
            last, self.held = last.copy(), held.copy()
            last[:, c] += 1
            self.held[:, c] += 1
            self.shift = [v[mark[0], c] if mark else None for mark in self.marks]
        # `most`: by the third character, the most that a unit's characters add as second; `widest`: by the first.
        self.most = self.held @ np.maximum(v.max(axis=0), 0)
        self.widest = self.held @ np.maximum(v.max(axis=2), 0).T
        self.right = np.hstack([last, later])
        self.right *= decay ** (1 + len(before))
        self.third = self.right[:, : len(v)]
        # For bounds without vectors: highest values, and sums of those that are not negative.
        self.open, self.one = np.maximum(two.max(axis=1), 0), one.sum(axis=1)
        self.thirds, self.top = self.third.sum(axis=1), self.most.max(axis=1)
        self.close = np.maximum(self.right[:, len(v) :].max(axis=1), 0)


class _Pairs:
    """Sums of windows of a list of units, from bounds of the pairs of their units.

    A pair is bounded by single numbers first. Where a window is still of interest, it is bounded by
    vectors, then the part of the marks in front of its units is summed, and at last all is exact.
    """

    STEPS = 3

    def __init__(self, v: np.ndarray, units: _Units, tail: np.ndarray, head: np.ndarray):
        self.v, self.units, self.tail, self.head = v, units, tail, head
        # Sums that start in a window's first unit; likewise, by its number of units, in a run of later ones.
        self.opened = units.sums[0][tail]
        self.inner = [self.opened[:0], units.sums[1][head]]
        # Whether a step was done for the pair of a unit and the one at a distance.
        self.done: dict[tuple[int, bool, int], np.ndarray] = {}
        self.ends = np.cumsum(units.size[head])
        self.fades = np.float32(DECAY) ** np.arange(4 * LONGEST, dtype=np.float32)
        self.tops = self._added(units.top)
        self.start, self.last = (units.open[tail], units.one[tail]), (units.thirds[head], units.close[head])
        self.marks = []
        for mark, shift in zip(units.marks, units.shift):
            if mark:
                high = np.maximum(mark[1].max(axis=1), 0)
                between = self._added(high + max(0, shift.max()))
                close = units.right[:, len(v) + mark[0]][head]
                self.marks.append((mark[2][tail], high[tail], between, close))
            else:
                self.marks.append(None)

    def _added(self, values: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(values[self.head], dtype=np.float64)])

    def total(self, start: np.ndarray, many: int) -> np.ndarray:
        """Sums, or bounds of them, of the windows of `many` units from `start` on."""
        return self.opened[start] + sum(self.inner[many - k][start + k] for k in range(1, many))

    def add(self, start: np.ndarray, last: np.ndarray) -> None:
        """Bounds of the pairs of `start` and `last`, all at the next distance."""
        fade = self.fades[self.ends[last - 1] - self.ends[start]]
        thirds, close = (array[last] for array in self.last)
        opened, one = (array[start] for array in self.start)
        both = opened * thirds + one * (close + thirds * (self.tops[last] - self.tops[start + 1]))
        self.inner.append(self.inner[-1].copy())
        for mark, sums in zip(self.marks, (self.opened, self.inner[-1])):
            if mark:
                faded, high, between, close = mark
                high = high[start] + (between[last] - between[start + 1])
                sums[start] += fade * (both + faded[start] * (high * thirds + close[last]))
            else:
                sums[start] += fade * both

    def refine(self, start: np.ndarray, gap: int, part: int, step: int) -> None:
        """The next step for unit `part` and unit `part + gap` of the windows from `start` on."""
        later = part > 0 and step == 1
        if step == 1 and not self.marks[later] or step == 2 and gap == 1:
            return
        done = self.done.setdefault((step, later, gap), np.zeros(len(self.head), bool))
        places = start + part
        places = places[~done[places]]
        done[places] = True
        all_sums = [self.opened] if step == 1 and not later else self.inner[gap + 1 :]
        all_sums = all_sums if step == 1 else [self.opened, *all_sums]
        for at in range(0, len(places), _STARTS):
            some = places[at : at + _STARTS]
            a, b, between = self.tail[some], self.head[some + gap], [self.head[some + k] for k in range(1, gap)]
            wrong = self._marked(a, b, between, later) if step == 1 else self._summed(a, b, between, step == 2)
            wrong *= self.fades[self.ends[some + gap - 1] - self.ends[some]]
            for sums in all_sums:
                sums[some] += wrong

    def _marked(self, a: np.ndarray, b: np.ndarray, between: list[np.ndarray], later: bool) -> np.ndarray:
        """What the bound of a mark's sums is wrong by."""
        (_, through, faded), shift = self.units.marks[later], self.units.shift[later]
        sums, high = through[a], np.maximum(through[a].max(axis=1), 0)
        for z in between:
            sums += through[z] + shift
            high += np.maximum(through[z].max(axis=1), 0) + max(0, shift.max())
        return faded[a] * (np.einsum("ij,ij->i", sums, self.units.third[b]) - high * self.units.thirds[b])

    def _summed(self, a: np.ndarray, b: np.ndarray, between: list[np.ndarray], exact: bool) -> np.ndarray:
        """What bounds without vectors are wrong by against those with them, or these if `exact`."""
        units, second = self.units, np.float32(0)
        left, right, one, thirds = units.left[a], units.right[b], units.one[a], units.thirds[b]
        ahead, third = left[:, len(self.v) :], right[:, : len(self.v)]
        if between:
            # The lesser of two bounds of subsequences with their second character between.
            most = one * np.einsum("ij,ij->i", sum(units.most[z] for z in between), third)
            widest = thirds * np.einsum("ij,ij->i", ahead, sum(units.widest[z] for z in between))
            second = np.minimum(most, widest)
        if not exact:
            top = sum(units.top[z] for z in between)
            bound = units.open[a] * thirds + one * (units.close[b] + thirds * top)
            return second + np.einsum("ij,ij->i", left, right) - bound
        held, wrong = sum(units.held[z] for z in between), -second
        for c in range(held.shape[1]):
            rows = np.flatnonzero(held[:, c])
            wrong[rows] += held[rows, c] * np.einsum("ij,ij->i", ahead[rows] @ self.v[:, c, :], third[rows])
        return wrong


class Windows:
    """The highest value of a machine over all windows of texts.

    A window's sum is the sum over its units of their own sums, and over pairs of its units of the
    subsequences that start in the one and end in the other. Pairs are bounded first and summed more
    exactly, nearest ones first, as long as the window may be above its text's best. Its kernel with
    itself is at least that of as many unequal characters and what its units have above that.
    """

    def __init__(self, landmarks: Landmarks, weights: np.ndarray, offset: float, keep: int = 0):
        self.tensor, self.offset, self.keep = landmarks.tensor(weights), offset, keep
        self.v = self.tensor.v.astype(np.float32)
        # The kernel of a string of n characters with itself is least if no two are equal.
        spans = np.arange(3, 4 * LONGEST)
        least = np.cumsum(np.cumsum((spans - 2) * DECAY ** (2.0 * spans)))
        self.least = np.concatenate([np.full(3, np.inf), least])
        # Strings known from earlier texts: row in the arrays, by string; number of calls that had it.
        self._rows: dict[str, int] = {}
        self._kept: list[np.ndarray] = []
        self._uses = np.zeros(keep, np.int32)

    def unit_bounds(self, units: list[str]) -> np.ndarray:
        """Bounds of the values of units that are letters alone and not longer than LONGEST."""
        (length, total, _, _, _, later, *_, excess), rows = self._known(units)
        total, size = total[rows], length[rows] + 1
        start = self.tensor.place.get(_START)
        if start is not None:
            total = total + np.float32(DECAY) * later[rows, start]
        return np.maximum(total, 0) / np.sqrt(self.least[size] + excess[rows]) + self.offset + _SLACK

    def raised(self, values: list[str], codes: np.ndarray, text: np.ndarray, best: np.ndarray) -> dict[int, str]:
        """Raise each text's `best` to its highest window; the windows that did so, by text.

        codes: the texts' units as places in `values`, none empty; text: the unit's place in `best`.
        """
        found: dict[int, str] = {}
        if len(codes) < 2:
            return found
        used = np.flatnonzero(np.bincount(codes, minlength=len(values)))
        place = np.zeros(len(values), np.int64)
        place[used] = np.arange(len(used))
        codes, values = place[codes], [values[k] for k in used.tolist()]
        heads, tails = ([v[some] for v in values] for some in (slice(LONGEST), slice(-LONGEST, None)))
        plain = np.array([len(v) <= LONGEST and v.isalpha() for v in values])
        at = {values[k]: n for n, k in enumerate(np.flatnonzero(plain).tolist())}
        # Places of tails and heads, and of their letters, which are all the same for most units.
        places = np.zeros((4, len(values)), np.int64)
        places[:, plain] = np.arange(len(at))
        for k in np.flatnonzero(~plain).tolist():
            ends = tails[k], heads[k]
            places[:, k] = [at.setdefault(s, len(at)) for s in (*ends, *map(_letters, ends))]
        kept, rows = self._known(list(at))
        base = tuple(array[rows] for array in kept)
        left = np.hstack([base[3], base[2]])
        sizes = np.fromiter(map(len, values), np.int64, len(values))[codes]
        for form, before in ((1, ""), (0, " ")):
            tail, head = places[2 * form : 2 * form + 2, codes]
            units = _Units(self.tensor, base, left, before)
            for start, many, total in self._totals(units, tail, head, sizes, text, best):
                self._compare(start, many, total, form, heads, tails, codes, text, best, found)
            # Not beside the next one's.
            del units
        return found

    def _known(self, strings: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Arrays of what is known of strings, and the row of each; at most `keep` rows stay for later texts."""
        if not strings or len(strings) > self.keep:
            return self._sums(strings), np.arange(len(strings))
        new = [s for s in strings if s not in self._rows]
        if len(self._rows) + len(new) > self.keep:
            self._forget(len(strings))
            new = [s for s in strings if s not in self._rows]
        # A few at once, for the worker's memory.
        for part in (new[k : k + _STARTS] for k in range(0, len(new), _STARTS)):
            sums, at = self._sums(part), len(self._rows)
            self._kept = self._kept or [np.zeros((self.keep, *a.shape[1:]), a.dtype) for a in sums]
            for array, rows in zip(self._kept, sums):
                array[at : at + len(part)] = rows
            self._rows.update(zip(part, range(at, at + len(part))))
        rows = np.fromiter((self._rows[s] for s in strings), np.int64, len(strings))
        self._uses[rows] += 1
        return self._kept, rows

    def _forget(self, many: int) -> None:
        """Make room for `many` strings; those that came up more often stay if there is room for them too."""
        often = np.flatnonzero(self._uses[: len(self._rows)] > 2)
        often = often if len(often) + many <= self.keep else often[:0]
        names = list(self._rows)
        self._rows = {names[k]: n for n, k in enumerate(often.tolist())}
        for array in self._kept:
            array[: len(often)] = array[often]
        self._uses[:] = 0

    def _sums(self, strings: list[str]) -> list[np.ndarray]:
        """Per string: length, what `_Units` takes of it, and its kernel with itself above the least.

        Strings with the same beginning share its sums: one more character is added at a time.
        """
        v, size, count = self.v, len(self.v), len(strings)
        length = np.fromiter(map(len, strings), np.int64, count)
        # total; one, two: open subsequences of one character, of two by the third to come;
        # last, later: characters as third, as second and third by the first; held: their numbers.
        found = [np.zeros((count, size)[:k], np.float32) for k in (1, 2, 2, 2, 2, 2)]
        codes = self.tensor.places(strings, max(1, int(length.max(initial=1))), False)
        states = [np.zeros((1, size)[:k], np.float32) for k in (1, 2, 2, 2, 2, 2)]
        node, rows, decay = np.zeros(count, np.int64), np.arange(count), np.float32(DECAY)
        for t in range(codes.shape[1]):
            rows = rows[length[rows] > t]
            if not rows.size:
                break
            parents = len(states[0])
            keys, node[rows] = np.unique((codes[rows, t] + 1) * parents + node[rows], return_inverse=True)
            parent, code = keys % parents, keys // parents - 1
            total, one, two, last, later, held = states = [state[parent] for state in states]
            one *= decay
            two *= decay
            fade = np.float32(DECAY ** (t + 1))
            cuts = np.searchsorted(code, np.arange(size + 1)).tolist()
            for c, some in enumerate(map(slice, cuts, cuts[1:])):
                if some.start < some.stop:
                    total[some] += decay * two[some, c]
                    two[some] += one[some] @ v[:, c, :]
                    one[some, c] += 1
                    later[some] += fade * (held[some] @ v[:, :, c].T)
                    held[some, c] += 1
                    last[some, c] += fade
            ended = rows[length[rows] == t + 1]
            for array, state in zip(found, states):
                array[ended] = state[node[ended]]
        del states
        excess = np.maximum(_own(strings) - np.where(length < ORDER, 0, self.least[length]), 0)
        return [length, *found, excess]

    def _totals(self, units: _Units, tail: np.ndarray, head: np.ndarray, sizes: np.ndarray, text: np.ndarray,
                best: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Starts, number of units and sums of the windows that may be above their text's best."""
        # A kernel with itself is at least that of as many unequal characters and its units' excess.
        excess = np.concatenate([[0], np.cumsum(units.excess[head])])
        first, least = units.excess[tail] - excess[1:], self.least

        def high(start: np.ndarray, many: int, length: np.ndarray) -> tuple[np.ndarray, ...]:
            own = np.sqrt(least[length] + (first[start] + excess[start + many]))
            total = pairs.total(start, many)
            # Whatever is negative is bounded by 0.
            missing = best[text[start]] - (self.offset + _SLACK)
            kept = np.flatnonzero((total > missing * own) | (missing < 0))
            return start[kept], total[kept], length[kept]

        pairs = _Pairs(self.v, units, tail, head)
        start, many, length, wide = np.arange(len(text)), 1, units.bare[tail] + 1, sizes
        while True:
            many += 1
            last = start + many - 1
            in_text = np.flatnonzero(last < len(text))
            start, last, length, wide = start[in_text], last[in_text], length[in_text], wide[in_text]
            wide = wide + 1 + sizes[last]
            fits = np.flatnonzero((text[last] == text[start]) & ((wide <= LONGEST) | (many == 2)))
            if not fits.size:
                return
            start, last, wide = start[fits], last[fits], wide[fits]
            length = length[fits] + units.size[head[last]]
            pairs.add(start, last)
            some, total, size = high(start, many, length)
            for step in range(pairs.STEPS):
                for gap in range(1, many):
                    if some.size:
                        for part in range(many - gap):
                            pairs.refine(some, gap, part, step)
                        some, total, size = high(some, many, size)
            if some.size:
                yield some, many, total

    def _compare(self, start, many, total, form, heads, tails, codes, text, best, found) -> None:
        """Compare windows in full, highest bounds first, as long as a bound is above the best."""
        windows = [
            " ".join([tails[codes[i]], *[heads[c] for c in codes[i + 1 : i + many].tolist()]]) for i in start.tolist()
        ]
        strings = [_START + (_letters(w) if form else w) for w in windows]
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = np.where(total > 0, total / np.sqrt(_own(strings)), 0) + self.offset + _SLACK
        order = np.lexsort((start, -bound, text[start]))
        order = order[bound[order] > best[text[start[order]]]]
        of, bound, at_once = text[start[order]], bound[order], 1
        while order.size:
            now = np.arange(len(of)) - np.searchsorted(of, of) < at_once
            chosen = order[now].tolist()
            once = {s: k for k, s in enumerate(dict.fromkeys(strings[i] for i in chosen))}
            scores = (self.tensor.values(list(once)) + self.offset).tolist()
            for t, i in zip(of[now].tolist(), chosen):
                if scores[once[strings[i]]] > best[t]:
                    best[t] = scores[once[strings[i]]]
                    found[t] = windows[i]
            left = ~now & (bound > best[of])
            order, bound, of = order[left], bound[left], of[left]
            at_once *= 4


@dataclass
class Model:
    landmarks: Landmarks | None
    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def windows(self, keep: int = 0) -> Windows:
        return Windows(self.landmarks, self.weights, self.offset, keep)

    def margins(self, units: list[str]) -> np.ndarray:
        """Highest margin of each unit's pieces."""
        if not units:
            return np.zeros(0)
        pieces = [_pieces(u) for u in units]
        flat = [p for ps in pieces for p in ps]
        scores = self.landmarks.weighed(flat, self.weights) + self.offset
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return np.maximum.reduceat(scores, np.cumsum(sizes) - sizes)

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins.astype(np.float64) + self.shift, -60, 60)))


def _support_vectors(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last weight is the offset."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    for _ in range(30):
        inside = y * (x @ w) < 1
        xs, cs = x[inside], cost[inside]
        new = np.linalg.solve(xs.T @ (xs * cs[:, None]) + np.diag(keep), xs.T @ (cs * y[inside]))
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def _sigmoid(margins: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of the label's probability, by Newton steps on smoothed targets.

    `share` of the labelled documents are toxic; the sample holds another proportion.
    """
    positive, negative = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    weight = np.where(labels == 1, share / positive, (1 - share) / negative)
    x = np.stack([margins.astype(np.float64), np.ones(len(margins))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        slope = x.T @ (weight * (p - target)) + 1e-6 * w
        curve = x.T @ (x * (weight * p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w - step / max(1.0, np.abs(step).max())
    return float(w[0]), float(w[1])


def _unlike(units: list[str], many: int, alike: float) -> list[str]:
    """The first `many` of the units, each less than `alike` to those before it."""
    strings = [_START + u[:LONGEST] for u in units]
    near = np.zeros(len(strings), np.float32)
    chosen: list[str] = []
    while len(chosen) < many:
        far = np.flatnonzero(near < alike)
        if not far.size:
            break
        chosen.append(strings[far[0]])
        near = np.maximum(near, _similarity(strings, chosen[-1]))
        near[far[0]] = 1
    return chosen


def _similarity(strings: list[str], one: str) -> np.ndarray:
    codes = _codes([one], len(one), -2)[:, :, None]
    found = np.zeros(len(strings), np.float32)
    own = _self_kernel([one])[0]
    for at in range(0, len(strings), _AT_ONCE):
        part = strings[at : at + _AT_ONCE]
        left = np.ascontiguousarray(_codes(part, max(map(len, part)), -1).T)
        scale = np.sqrt(own * _self_kernel(part))
        found[at : at + _AT_ONCE] = np.where(scale > 0, _kernel(left, codes)[0] / np.maximum(scale, 1e-30), 0)
    return found


def _without_copies(documents: list[tuple[int, list[str], list[str]]]) -> list[tuple[int, list[str], list[str]]]:
    """Documents that share less than half of their eight smallest unit hashes with an earlier one."""
    seen: dict[int, set[int]] = {}
    kept = []
    for n, (label, units, words) in enumerate(documents):
        least = sorted({zlib.crc32(u.encode("utf-8", "surrogatepass")) for u in units})[:8]
        shared = Counter(k for h in least for k in seen.get(h, ()))
        if shared and max(shared.values()) * 2 >= len(least):
            continue
        for h in least:
            seen.setdefault(h, set()).add(n)
        kept.append((label, units, words))
    return kept


def _hash(window: str) -> int:
    return zlib.crc32(window.encode("utf-8", "surrogatepass"))


def _with_windows(toxic: list[tuple], clean: list[tuple]) -> tuple[list[list[str]], list[list[str]]]:
    """Units of (units, words) with the windows that tell more than their words, and other clean ones."""
    hashes = [np.unique(np.array([_hash(w) for w in windows_of(words)], np.int64)) for _, words in toxic]
    values, counts = np.unique(np.concatenate(hashes), return_counts=True)
    # As often in toxic documents by chance: at most once in a hundred such samples.
    share = len(toxic) / (len(toxic) + len(clean))
    least = max(3, math.ceil(math.log(100 * max(1, len(values))) / -math.log(share)))
    wanted = set(values[counts >= least].tolist())
    bags = [[{w for w in windows_of(words) if _hash(w) in wanted} for _, words in some] for some in (toxic, clean)]
    bad, good = (Counter(w for bag in some for w in bag) for some in bags)
    had = [Counter(u for units, _ in some for u in set(units)) for some in (toxic, clean)]

    def odds(bad_: int, good_: int) -> float:
        return math.log((bad_ + 0.2) / (len(toxic) + 0.4)) - math.log((good_ + 0.2) / (len(clean) + 0.4))

    telling = {
        w for w, n in bad.items()
        if n >= least and 30 * good[w] < n
        and odds(n, good[w]) > 0.5 + max(odds(had[0][u], had[1][u]) for u in w.split(" "))
    }
    some = [[w for w in set(windows_of(words)) if _hash(w) % _NEGATIVES == 0] for _, words in clean]
    return (
        [[*units, *(bag & telling)] for (units, _), bag in zip(toxic, bags[0])],
        [[*units, *(bag & telling), *more] for (units, _), bag, more in zip(clean, bags[1], some)],
    )


class _Sample:
    """Training documents as bags of units, with what is known of each unit."""

    def __init__(self, toxic: list[list[str]], clean: list[list[str]]):
        self.units = sorted({u for us in toxic + clean for u in us})
        place = {u: k for k, u in enumerate(self.units)}
        self.toxic = [np.unique([place[u] for u in us]) for us in toxic]
        self.clean = [np.unique([place[u] for u in us]) for us in clean]
        self.bad = np.bincount(np.concatenate(self.toxic), minlength=len(self.units))
        self.good = np.bincount(np.concatenate(self.clean), minlength=len(self.units))
        self.odds = np.log((self.bad + 0.2) / (len(toxic) + 0.4)) - np.log((self.good + 0.2) / (len(clean) + 0.4))
        long = np.array([len(u) >= ORDER for u in self.units])
        # Units that several toxic documents have and hardly a clean one are examples in any case.
        self.strong = long & (self.bad > 2) & (30 * self.good < self.bad)
        self.telling = long & (self.odds > 1)
        self.clean_units = np.flatnonzero((self.good > 0) & ~self.strong)
        pieces = [_pieces(u) for u in self.units]
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pieces = [p for ps in pieces for p in ps]

    def named(self, order: np.ndarray) -> list[str]:
        return [self.units[k] for k in order.tolist()]

    def machine(self, landmarks: Landmarks, known: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the machine over the landmarks, and every unit's margin."""
        rng = np.random.default_rng(6)
        features = landmarks.features(self.pieces, known)
        score, best_piece = self.odds, self.starts
        witnesses = [bag[self.strong[bag]] for bag in self.toxic]
        w = np.zeros(features.shape[1] + 1)
        for turn in range(ROUNDS):
            highest = [bag[[np.argmax(score[bag])]] for bag in self.toxic]
            witness, uses = np.unique(np.concatenate(highest + witnesses), return_counts=True)
            # Toxic documents whose best unit is far off have no witness: their label is left aside.
            believed = self.strong[witness] | (self.telling[witness] & ((score[witness] > -1) | (turn == 0)))
            if believed.any():
                witness, uses = witness[believed], uses[believed]
            often = witness[np.argsort(-uses, kind="stable")][: 4 * LANDMARKS]
            altered = [_inserted(u, rng) for u in self.named(often) if len(u) > 3 for _ in range(2)]
            hardest = self.clean_units[np.argsort(-score[self.clean_units], kind="stable")[:4000]]
            others = rng.choice(self.clean_units, min(8000, len(self.clean_units)), replace=False)
            negative = np.union1d(hardest, others)
            parts = [features[best_piece[witness]], features[best_piece[negative]]]
            labels = [np.ones(len(witness)), -np.ones(len(negative))]
            costs = [uses / uses.sum(), np.full(len(negative), 2.0 / max(1, len(negative)))]
            if altered:
                parts.append(landmarks.features([_pieces(a)[0] for a in altered]))
                labels.append(np.ones(len(altered)))
                costs.append(np.full(len(altered), 0.5 / len(altered)))
            w = _support_vectors(np.vstack(parts), np.concatenate(labels), np.concatenate(costs))
            flat = features @ w[:-1] + w[-1]
            score = np.maximum.reduceat(flat, self.starts)
            best_piece = self.starts.copy()
            for k in np.flatnonzero(self.sizes > 1).tolist():
                best_piece[k] += int(np.argmax(flat[self.starts[k] : self.starts[k] + self.sizes[k]]))
        return w, score


def fit(labelled: list[tuple[int, list[str]]], share: float = 0.1) -> Model:
    """Train on documents given as (label, lower-case words)."""
    once: dict[str, str] = {}
    documents = []
    for label, words in labelled:
        bare = [once.setdefault(b, b) for w in words if (b := w.strip(_ROUND))]
        units = sorted({once.setdefault(u, u) for u in units_of(words)})
        documents.append((label, units, bare))
    documents = _without_copies(documents)
    toxic = [(us, ws) for y, us, ws in documents if y == 1 and us]
    clean = [(us, ws) for y, us, ws in documents if y == 0 and us]
    if not toxic or not clean:
        return Model(None, np.zeros(0), 0.0, 0.0, -60.0)
    bags = _with_windows(toxic, clean)
    sample = _Sample(*bags)
    # Rare units tell little: the count tempers the odds.
    useful = np.flatnonzero((sample.odds > 0.5) & (sample.bad > 1) & [len(u) >= ORDER for u in sample.units])
    telling = useful[np.argsort(-(sample.odds * np.log1p(sample.bad))[useful], kind="stable")]
    common = np.argsort(-sample.good, kind="stable")
    common = [u for u in sample.named(common[: 40 * LANDMARKS]) if len(u) > ORDER]
    marks = _unlike(sample.named(telling[: 40 * LANDMARKS]), LANDMARKS * 2 // 3, 0.5)
    marks += _unlike(common, LANDMARKS - len(marks), 0.5) or [_START + "none"]
    landmarks = Landmarks(marks)
    _, score = sample.machine(landmarks)
    # The clean units that come closest to toxic ones mark the border.
    closest = sample.clean_units[np.argsort(-score[sample.clean_units], kind="stable")[: 20 * LANDMARKS]]
    border = _unlike(sample.named(closest), LANDMARKS // 3, 0.7)
    landmarks = Landmarks(list(dict.fromkeys(marks[: LANDMARKS * 2 // 3] + border)))
    known: dict[str, np.ndarray] = {}
    w, score = sample.machine(landmarks, known)
    # The windows that raise clean documents most become examples, however few documents have them.
    words = [ws for _, ws in toxic + clean]
    tops = np.array([score[bag].max() for bag in sample.toxic + sample.clean])
    hard = _highest_windows(Windows(landmarks, w[:-1], float(w[-1])), words, tops)
    for n, bag in enumerate(bags[1], len(toxic)):
        bag += [hard[n]] if n in hard else []
    sample = _Sample(*bags)
    w, score = sample.machine(landmarks, known)
    tops = np.array([score[bag].max() for bag in sample.toxic + sample.clean])
    labels = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    _highest_windows(Windows(landmarks, w[:-1].astype(np.float32), float(w[-1])), words, tops)
    slope, shift = _sigmoid(tops, labels, share)
    return Model(landmarks, w[:-1].astype(np.float32), float(w[-1]), slope, shift)


def _highest_windows(windows: Windows, documents: list[list[str]], best: np.ndarray) -> dict[int, str]:
    """Raise the documents' `best` to their highest windows; the windows that did so, by document."""
    found: dict[int, str] = {}
    for at in range(0, len(documents), _DOCUMENTS):
        some = documents[at : at + _DOCUMENTS]
        values = sorted({w for words in some for w in words})
        place = {w: k for k, w in enumerate(values)}
        codes = np.array([place[w] for words in some for w in words], np.int64)
        text = np.repeat(np.arange(len(some)), list(map(len, some)))
        raised = windows.raised(values, codes, text, best[at : at + _DOCUMENTS])
        found.update((at + n, window) for n, window in raised.items())
    return found


def _inserted(unit: str, rng: np.random.Generator) -> str:
    at = int(rng.integers(1, len(unit)))
    return unit[:at] + str(rng.choice(list("-*._x "))) + unit[at:]


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learned from."""
    return F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Model from at most `per_class` labelled documents of each label that are not held out."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max("toxic").alias("_toxic"))
    )
    order = F.xxhash64("_id")
    # Bounded by the parameter: two sorts that keep `per_class` rows each.
    some = known.where("_toxic = 1").orderBy(order, "_id").limit(per_class).unionByName(
        known.where("_toxic = 0").orderBy(order, "_id").limit(per_class)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [(t.as_py() or "").lower().split() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_toxic"), pa.array(cut, pa.list_(pa.string()))],
                ["_id", "_toxic", "words"],
            )

    cut = in_arrow(
        rows.select(F.col("_id").cast("long").alias("_id"), F.col("_toxic").cast("int").alias("_toxic"), "text"),
        run,
        "_id bigint, _toxic int, words array<string>",
    ).collect()
    once: dict[str, str] = {}
    rows = [(r["_id"], [once.setdefault(w, w) for w in r["words"]], r["_toxic"]) for r in cut]
    del cut, once
    rows.sort(key=lambda r: r[:2])
    sizes = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    return fit([(label, words) for _, words, label in rows], share)


class Scorer:
    """A model with the units that this task has scored."""

    def __init__(self, model: Model):
        self.model = model
        self._windows = model.windows(_KEPT) if model.landmarks else None
        self._known: dict[str, float] = {}

    def _margins(self, units: list[str]) -> list[float]:
        known = self._known
        if len(known) > _REMEMBERED:
            known.clear()
        new = list(dict.fromkeys(u for u in units if u and u not in known))
        known.update(zip(new, self.model.margins(new).tolist()))
        return [known[u] if u else -np.inf for u in units]

    def of_batch(self, texts: pa.Array) -> np.ndarray:
        """Probability for each text, a slice of the batch at a time."""
        sizes = pc.utf8_length(pc.fill_null(texts, "")).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes.astype(np.int64)) // _SLICE_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        parts = [self.scores(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:]) if b > a]
        return np.concatenate(parts) if parts else np.zeros(0)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability for each text."""
        if self.model.landmarks is None:
            return np.zeros(len(texts))
        # Blanks at the end go first: Arrow's split looks at the bytes behind them.
        words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.utf8_lower(pc.fill_null(texts, ""))))
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        bare = [v.strip(_ROUND) for v in coded.dictionary.to_pylist()]
        once = {v: k for k, v in enumerate(dict.fromkeys(bare))}
        values = list(once)
        unit = np.fromiter((once[v] for v in bare), np.int64, len(bare))
        codes = unit[coded.indices.to_numpy(zero_copy_only=False)]
        best = np.full(len(texts), -np.inf)
        if len(codes):
            self._units(values, codes, counts, best)
            self._joined(values, codes, counts, best)
            filled = np.array([bool(v) for v in values])[codes]
            text = np.repeat(np.arange(len(texts)), counts)
            self._windows.raised(values, codes[filled], text[filled], best)
        # The last digits follow from what was summed together; equal texts have equal scores without.
        return self.model.probability(np.where(np.isfinite(best), best.round(_DIGITS), -10.0))

    def _units(self, values: list[str], codes: np.ndarray, counts: np.ndarray, best: np.ndarray) -> None:
        """Raise each text's `best` to its highest unit; only units whose bound is above it are scored."""
        plain = np.array([len(v) <= LONGEST and v.isalpha() for v in values])
        bound = np.full(len(values), np.inf)
        places = np.flatnonzero(plain)
        bound[places] = self._windows.unit_bounds([values[k] for k in places.tolist()])
        bound[[not v for v in values]] = -np.inf
        filled = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[filled]
        margins = np.full(len(values), -np.inf)
        # Units without a bound and each text's highest by its bound come first.
        highest = np.zeros(len(counts))
        highest[filled] = np.maximum.reduceat(np.where(plain, bound, -np.inf)[codes], starts)
        of = np.repeat(highest, counts)
        chosen = bound[codes] >= of
        text = np.repeat(np.arange(len(counts)), counts)
        for _ in range(2):
            some = np.unique(codes[chosen])
            margins[some] = self._margins([values[k] for k in some.tolist()])
            best[filled] = np.maximum.reduceat(margins[codes], starts)
            chosen = (bound[codes] > best[text]) & np.isneginf(margins[codes])

    def _joined(self, values: list[str], codes: np.ndarray, counts: np.ndarray, best: np.ndarray) -> None:
        """Runs of single characters, in the texts that have them."""
        single = np.array([len(v) == 1 for v in values], bool)[codes]
        text = np.repeat(np.arange(len(counts)), counts)
        three = single[:-2] & single[1:-1] & single[2:] & (text[:-2] == text[2:])
        ends = np.cumsum(counts)
        for t in np.unique(text[:-2][three]).tolist():
            own = [values[c] for c in codes[ends[t] - counts[t] : ends[t]].tolist()]
            extra = units_of(own)[sum(1 for w in own if w) :]
            best[t] = max(best[t], *self._margins(extra))


def _scorer(model: Model, key: int) -> Scorer:
    """This Python worker's scorer; it keeps the last model only."""
    return keep_one(("scorer", key), lambda: Scorer(model))


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = hash((model.slope, model.shift, model.offset, model.weights.tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value, key)
        for batch in batches:
            scores = scorer.of_batch(batch.column("text").cast(pa.large_string()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], [*batch.schema.names[:-1], "score"]
            )

    return in_arrow(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract rows: doc_id, held_out, score, predicted."""
    scored = with_scores(docs, train(docs, labels))
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
    )


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below LIMIT, unchanged."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = hash((model.slope, model.shift, model.offset, model.weights.tobytes()))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value, key)
        for batch in batches:
            scores = scorer.of_batch(batch.column("text").cast(pa.large_string()))
            yield batch.filter(pa.array(scores < LIMIT))

    kept = docs.select(*columns)
    return in_arrow(kept, run, kept.schema)
