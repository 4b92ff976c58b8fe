"""Token counts by byte-pair merging with a heap over a linked list, without making identifiers.

The symbols of a piece are its bytes. The adjacent pair of lowest rank, leftmost on ties, is popped and merged
until no pair has a rank; the count is the number of first symbols less the merges.

Defined cases: a null or empty text has 0 tokens and 0 bytes; texts of any length are counted whole (a piece of
n bytes costs n log n); strings of special tokens count as one token each, as the library takes them; repeated
rows are counted alike; other columns are not read.
"""

from __future__ import annotations

import functools
import heapq
import json
import re

import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.units import Units


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in vocabularies of this kind."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class MergeCounter:
    """Counts tokens with the merges of a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        self.symbols = [vocabulary[c] for _, c in sorted(_byte_alphabet().items())]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocabulary[left] << 20 | vocabulary[right]] = rank
            self.merged.append(vocabulary[left + right])
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.pieces = regex.compile(PATTERN)
        self.units = Units(lambda units: map(self.unit, units))

    def left_after_merging(self, data: bytes) -> int:
        ranks, merged = self.ranks, self.merged
        symbols = [self.symbols[b] for b in data]
        n = len(symbols)
        # A heap entry is rank * n + position: the lowest rank first, the leftmost on ties.
        heap = []
        for at in range(n - 1):
            rank = ranks.get(symbols[at] << 20 | symbols[at + 1])
            if rank is not None:
                heap.append(rank * n + at)
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            rank, at = divmod(heapq.heappop(heap), n)
            right = after[at]
            if symbols[at] < 0 or right >= n or ranks.get(symbols[at] << 20 | symbols[right]) != rank:
                continue  # an entry of a pair that is gone
            left -= 1
            symbols[at], symbols[right] = merged[rank], -1
            follower = after[at] = after[right]
            if follower < n:
                before[follower] = at
                new = ranks.get(symbols[at] << 20 | symbols[follower])
                if new is not None:
                    heapq.heappush(heap, new * n + at)
            if (leader := before[at]) >= 0:
                new = ranks.get(symbols[leader] << 20 | symbols[at])
                if new is not None:
                    heapq.heappush(heap, new * n + leader)
        return left

    def _plain(self, text: str) -> int:
        if text.isalpha() or (text[:1] == " " and text[1:].isalpha()):
            return self.left_after_merging(text.encode())
        return sum(self.left_after_merging(piece.encode()) for piece in self.pieces.findall(text))

    def unit(self, text: str) -> int:
        if self.special is None or "<" not in text and not self.special.search(text):
            return self._plain(text) if text else 0
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(part) for part in parts if part)

    def count(self, texts) -> list[int]:
        return [sum(values) for values in self.units.of(texts)]


@functools.cache
def counter(path: str) -> MergeCounter:
    """One counter per worker process."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Per row ``doc_id``, ``n_bytes``, ``n_tokens`` and whether ``n_tokens`` exceeds ``limit``; ``path`` names a
    vocabulary file that every worker can open."""

    @F.arrow_udf("long")
    def n_tokens(texts: pa.Array) -> pa.Array:
        return pa.array(counter(path).count(t.as_py() for t in texts), pa.int64())

    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
