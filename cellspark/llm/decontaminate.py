"""Benchmark decontamination by the q-gram lemma in diagonal bands.

Two strings within k edits share at least ``n - q + 1 - k * q`` of the n - q + 1 character q-grams of the shorter
one, on diagonals no further apart than 2k. Documents are scanned once against all items of a block: shared q-grams
are counted in overlapping bands of diagonals, bands that reach the bound are aligned with banded dynamic
programming, and alignments within the budget are leaks. An item's budget is ``rate`` of its length, lowered where
the bound would not be positive (items under 2q characters must occur verbatim).

Texts are compared with A-Z lower-cased and runs of white space as one space. Items come to the workers in blocks of
bounded size, however many there are; documents are neither shuffled nor paired with one another.

Defined cases: null or empty texts leak nothing, null or empty items match nothing; repeated items are reported each,
repeated rows alike; texts of any length are scanned whole, in pieces that overlap by more than any alignment; equal
alignments go to the leftmost; other columns pass through :func:`mark` unchanged, and its new column may be named freely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Characters of items in one block, and of a document in one piece.
BLOCK = 4_000_000
PIECE = 1 << 16

_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Budget:
    """``rate`` edits per character of an item, found by ``q``-grams."""

    q: int = 10
    rate: float = 0.08

    def edits(self, length: int) -> int:
        return max(0, min(int(self.rate * length), (length - self.q) // self.q))


def normalized(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the normal form, and the place of each in the text."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 160)
    keep = ~blank
    if len(codes):
        keep[1:] |= blank[1:] & ~blank[:-1]
        keep[-1] &= ~blank[-1]
    places = np.flatnonzero(keep)
    codes = np.where(blank, np.uint32(32), np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes))[places]
    if len(codes) and codes[-1] == 32:
        return codes[:-1], places[:-1]
    return codes, places


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, put together from hashes of half the length."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    block, width, total, done = codes.astype(np.uint64) + np.uint64(1), 1, None, 0
    power = _BASE
    with np.errstate(over="ignore"):
        while True:
            if q & width:
                total = block[:n].copy() if total is None else total * power + block[done : done + n]
                done += width
            if width * 2 > q:
                return total
            block = block[:-width] * power + block[width:]
            power = power * power
            width *= 2


class Items:
    """One block of items with an index of their q-grams."""

    def __init__(self, rows: list[tuple[object, str]], budget: Budget) -> None:
        self.budget = budget
        self.rows = [(item, codes) for item, text in rows if len(codes := normalized(text)[0])]
        self.lengths = np.array([len(c) for _, c in self.rows], np.int64)
        self.edits = np.array([budget.edits(int(n)) for n in self.lengths], np.int64)
        # Shared q-grams that a band must reach.
        self.need = self.lengths - budget.q + 1 - self.edits * budget.q
        self.least = max(1, int(self.need.min(initial=1)))
        self.short = [i for i, n in enumerate(self.lengths) if n < budget.q]
        hashes = [gram_hashes(codes, budget.q) for _, codes in self.rows]
        grams = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        place = np.concatenate([*[np.arange(len(h)) for h in hashes], np.zeros(0, np.int64)])
        order = np.argsort(grams, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        bits = max(16, int(np.ceil(np.log2(64 * len(self.grams) + 1))))
        self.shift = np.uint64(64 - min(bits, 27))
        self.seen = np.zeros(1 << min(bits, 27), bool)
        self.seen[self._slot(self.grams)] = True
        self.masks: dict[tuple[int, bool], dict[int, int]] = {}
        self.margin = int((self.lengths + self.edits).max(initial=0)) + 1

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(32))) * _BASE) >> self.shift

    def _bands(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, lowest diagonal, width) of bands with enough shared q-grams."""
        hashes = gram_hashes(codes, self.budget.q)
        at = np.flatnonzero(self.seen[self._slot(hashes)])
        if not len(at):
            return []
        hashes = hashes[at]
        where = np.minimum(np.searchsorted(self.grams, hashes), len(self.grams) - 1)
        real = self.grams[where] == hashes
        at, where = at[real], where[real]
        if not len(at):
            return []
        repeat = self.count[where]
        entry = np.repeat(self.first[where] - np.cumsum(repeat) + repeat, repeat) + np.arange(repeat.sum())
        item, diagonal = self.item[entry], np.repeat(at, repeat) - self.place[entry]
        step = 2 * self.edits[item] + 1
        # Bands are two steps wide and one step apart, so any 2k + 1 diagonals lie in one of them.
        band = diagonal // step
        lowest = int(band.min()) - 1
        across = int(band.max()) - lowest + 1
        keys = item * across + (band - lowest)
        keys = np.concatenate([keys, keys - 1])
        # Counting by place pays only where most places are hit.
        if len(self.rows) * across <= min(1 << 20, 8 * len(keys)):
            shared = np.bincount(keys)
            keys = np.flatnonzero(shared >= self.least)
            shared = shared[keys]
        else:
            keys, shared = np.unique(keys, return_counts=True)
        item, band = keys // across, keys % across + lowest
        enough = np.flatnonzero(shared >= self.need[item])
        item, band = item[enough], band[enough]
        step = 2 * self.edits[item] + 1
        return list(zip(item.tolist(), (band * step).tolist(), (2 * step).tolist(), strict=True))

    def matches(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits), one for every place where a run of neighbouring bands aligns best."""
        found: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for item, low, width in self._bands(codes):
            pattern, k = self.rows[item][1], int(self.edits[item])
            hit = self._verbatim(codes, pattern, low, width) or self._aligned(codes, item, low, width, k)
            if hit is not None and hit[2] <= k:
                old = found.get((item, hit[1]))
                if old is None or hit[2] < old[3]:
                    found[item, hit[1]] = (item, *hit)
        text = None
        for item in self.short:
            text = text if text is not None else codes.astype("<u4").tobytes()
            pattern = self.rows[item][1].astype("<u4").tobytes()
            at = text.find(pattern)
            while at >= 0:
                if at % 4 == 0:
                    found[item, at // 4 + len(pattern) // 4] = (item, at // 4, at // 4 + len(pattern) // 4, 0)
                at = text.find(pattern, at + 1)
        return _apart(sorted(found.values()))

    @staticmethod
    def _verbatim(codes: np.ndarray, pattern: np.ndarray, low: int, width: int) -> tuple[int, int, int] | None:
        """The leftmost alignment without edits in a band."""
        for start in range(max(0, low), min(low + width, len(codes) - len(pattern) + 1)):
            if codes[start] == pattern[0] and codes[start + len(pattern) - 1] == pattern[-1] and np.array_equal(codes[start : start + len(pattern)], pattern):
                return start, start + len(pattern), 0
        return None

    def _masks(self, item: int, backwards: bool) -> dict[int, int]:
        """For every character of an item the bits of its places."""
        if (item, backwards) not in self.masks:
            pattern = self.rows[item][1].tolist()
            masks: dict[int, int] = {}
            for place, character in enumerate(reversed(pattern) if backwards else pattern):
                masks[character] = masks.get(character, 0) | 1 << place
            self.masks[item, backwards] = masks
        return self.masks[item, backwards]

    def _aligned(self, codes: np.ndarray, item: int, low: int, width: int, k: int) -> tuple[int, int, int] | None:
        """The whole item against the best part of the text that a band and k diagonals on either side cover."""
        n = len(self.rows[item][1])
        first = max(0, low - k)
        window = codes[first : max(0, low + width + k + 1 + n)]
        end, edits = _banded(window, self._masks(item, False), n, free_start=True)
        if edits > k:
            return None
        # Backwards from the end, where the path must begin, gives the start.
        back = window[max(0, end - n - k) : end][::-1]
        length, _ = _banded(back, self._masks(item, True), n, free_start=False)
        return first + end - length, first + end, edits


def _banded(band: np.ndarray, masks: dict[int, int], n: int, free_start: bool) -> tuple[int, int]:
    """(end, edits) of the best path of a pattern of ``n`` characters through a band of text, leftmost on ties.

    A column of the table is held as two bit strings, of the places where the edits step up and down, so a
    character of text costs a dozen operations on whole numbers (Myers).
    """
    every, last = (1 << n) - 1, 1 << (n - 1)
    up, down, edits = every, 0, n
    best, end = n, 0
    carried = 0 if free_start else 1
    for place, character in enumerate(band.tolist(), 1):
        equal = masks.get(character, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        rises = down | (every & ~(across | up))
        falls = up & across
        if rises & last:
            edits += 1
        elif falls & last:
            edits -= 1
        rises = rises << 1 | carried
        up = (falls << 1 | ~(vertical | rises)) & every
        down = rises & vertical & every
        if edits < best:
            best, end = edits, place
    return end, best


def _apart(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of overlapping matches of one item the one with fewest edits, leftmost on ties."""
    kept: list[tuple[int, int, int, int]] = []
    for match in found:
        if kept and kept[-1][0] == match[0] and match[1] < kept[-1][2]:
            if match[3] < kept[-1][3]:
                kept[-1] = match
        else:
            kept.append(match)
    return kept


def scan_text(items: Items, text: str | None) -> list[tuple[int, int, int, int]]:
    """(item, start, end, edits) in code points of the text."""
    codes, places = normalized(text)
    found = []
    # Neighbouring pieces share a margin longer than any alignment, so none is cut in both.
    for first in range(0, max(1, len(codes)), PIECE):
        piece = codes[first : first + PIECE + 2 * items.margin]
        found += [(i, int(places[first + a]), int(places[first + b - 1]) + 1, e) for i, a, b, e in items.matches(piece)]
    return _apart(sorted(set(found)))


def blocks(items: DataFrame, budget: Budget) -> Iterator[Items]:
    """Items in blocks of at most ``BLOCK`` characters (or one item), read one partition at a time."""
    rows, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        if rows and size + len(row["text"] or "") > BLOCK:
            yield Items(rows, budget)
            rows, size = [], 0
        rows.append((row["item_id"], row["text"]))
        size += len(row["text"] or "")
    yield Items(rows, budget)


def mark(docs: DataFrame, items: DataFrame, name: str = "leaks", budget: Budget = Budget()) -> DataFrame:
    """All columns of ``docs``, and the leaks of ``text``: ``array<struct<item_id, start, end, edits>>``."""
    item_type = items.schema["item_id"].dataType
    entry = T.StructType().add("item_id", item_type).add("start", T.LongType()).add("end", T.LongType()).add("edits", T.IntegerType())
    arrow_type = to_arrow_type(T.ArrayType(entry))

    def scanner(block: Items):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        @F.arrow_udf(T.ArrayType(entry))
        def leaks(texts: pa.Array) -> pa.Array:
            items = sent.value
            found = (scan_text(items, text.as_py()) for text in texts)
            return pa.array([[{"item_id": items.rows[i][0], "start": a, "end": b, "edits": e} for i, a, b, e in one] for one in found], arrow_type)

        # Not to be run once more in a filter that the planner derives from what is done with the column.
        return leaks.asNondeterministic()("text")

    return docs.withColumn(name, F.concat(*[scanner(block) for block in blocks(items, budget)]))


def clean(docs: DataFrame, items: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """The documents without leaks, with the same columns."""
    name = "leaks"
    while name in docs.columns:
        name += "_"
    return mark(docs, items, name, budget).where(F.size(name) == 0).drop(name)
