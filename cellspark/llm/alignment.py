"""How the tokens of two vocabularies over the same bytes lie on each other, with counts of id pairs over all documents.

Texts are cut at single blanks between other characters, where tokens of both vocabularies end; every word is
aligned once and remembered. Offsets where both tokens end cut a word into groups. A group of one token each with equal
bytes is looked up in an array from ids of the first vocabulary to ids of the second, and counted in one vector of the
vocabulary's length per task. Only pairs of other groups enter a shuffle, first summed up over a block of documents.
The totals of a block's pairs come back to the block, not to its documents.

Defined cases: texts that are null, empty, or whose tokens do not give back a blank and the text (a real U+2581, for
example) have no tokens: zeros, and an empty string for the hash; strings of special tokens are plain text; texts of any
length are aligned whole, a block holds one document at least; repeated rows count as often as they occur; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import packed_vector, ship, stored, sum_vectors, text_slices
from cellspark.llm.token_counts import _byte_alphabet

# Bytes of text in a block, one document at least.
BLOCK_BYTES = 2_000_000
# A worker remembers at most so many words, and those of one block; then it starts anew.
REMEMBERED = 400_000
WORDS_AT_ONCE = 400
_B_BITS = 24

_CUT = re.compile(r"(?<=\S) (?=\S)")
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


class Pair:
    """Both vocabularies, the bytes of their tokens, and the array from ids of the first to ids with the same bytes."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        byte_of = {c: b for b, c in _byte_alphabet().items()}
        plain = {n: bytes(byte_of[c] for c in entry) for entry, n in self.a.get_vocab(with_added_tokens=False).items()}
        plain |= {n: t.content.encode() for n, t in self.a.get_added_tokens_decoder().items()}
        self.a_bytes = [plain.get(n, b"") for n in range(max(plain) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        numbers = range(self.b.vocab_size())
        pieces = [self.b.id_to_piece(n) for n in numbers]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode() for n, p in zip(numbers, pieces, strict=True)]
        # Of several tokens with the same bytes the array takes the one that is no stand-in for a byte.
        first: dict[bytes, int] = {}
        for n in sorted(numbers, key=self.b.is_byte):
            if not self.b.is_control(n) and not self.b.is_unknown(n):
                first.setdefault(self.b_bytes[n], n)
        special = set(self.a.get_added_tokens_decoder())
        self.same = np.array([-1 if n in special else first.get(data, -1) for n, data in enumerate(self.a_bytes)], np.int64)
        self.a_size, self.b_size = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = [str(n) for n in range(len(self.a_bytes))], [str(n) for n in numbers]


@functools.cache
def pair(a_path: str, b_path: str) -> Pair:
    """One pair of vocabularies per process."""
    return Pair(a_path, b_path)


def pair_number(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a << _B_BITS | b


def _edged(word: str) -> bool:
    return not word or word[0].isspace() or word[-1].isspace()


class Words:
    """Aligned words by number: counts, written groups and links. A link is coded as the first id where a group is in
    the array, else as -1 - pair number."""

    def __init__(self, vocabularies: Pair) -> None:
        self.pair = vocabularies
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.counts: list[tuple[int, int, int, int]] = []
        self.groups: list[str] = []
        self.links: list[np.ndarray] = []
        self.lossless: list[bool] = []

    def learn(self, words: list[str]) -> dict[str, int]:
        """Numbers of new words."""
        self.fresh: dict[str, int] = {}
        joined = [w for w in words if not _edged(w)]
        alone = [[w] for w in words if _edged(w)]
        runs = [joined[i : i + WORDS_AT_ONCE] for i in range(0, len(joined), WORDS_AT_ONCE)]
        while runs or alone:
            alone += [[w] for run in self._align(runs[:50]) for w in run]
            runs = runs[50:]
            if not runs:
                for run in self._align(alone):
                    self._add(run[0], (0, 0, 0, 0), "", np.zeros(0, np.int64), lossless=False)
                alone = []
        return self.fresh

    def _add(self, word: str, counts: tuple[int, int, int, int], groups: str, links: np.ndarray, lossless: bool) -> None:
        self.fresh[word] = len(self.counts)
        self.counts.append(counts)
        self.groups.append(groups)
        self.links.append(links)
        self.lossless.append(lossless)

    def _align(self, runs: list[list[str]]) -> list[list[str]]:
        """Add the words of these runs; returns the runs that are not to be aligned in one piece."""
        p = self.pair
        texts = [" ".join(run) for run in runs]
        a_ids = [np.array(e.ids, np.int64) for e in p.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b_ids = [np.array(ids, np.int64) for ids in p.b.encode(texts, num_threads=1)] if texts else []
        failed, good = [], []
        for run, text, a, b in zip(runs, texts, a_ids, b_ids, strict=True):
            data = (" " + text).encode()
            equal = all(b"".join(map(table.__getitem__, ids.tolist())) == data for table, ids in ((p.a_bytes, a), (p.b_bytes, b)))
            size = np.array([len(w.encode()) + 1 for w in run], np.int64)
            borders = np.cumsum(size)
            if equal and len(run) > 1:
                equal = all(np.isin(borders, np.cumsum(sizes[ids]), assume_unique=True).all() for sizes, ids in ((p.a_size, a), (p.b_size, b)))
            if equal:
                good.append((run, size, a, b))
            else:
                failed.append(run)
        if good:
            self._add_runs(good)
        return failed

    def _add_runs(self, good: list[tuple]) -> None:
        p = self.pair
        words = [w for run, *_ in good for w in run]
        size, a, b = (np.concatenate([g[i] for g in good]) for i in (1, 2, 3))
        word_ends, a_ends, b_ends = np.cumsum(size), np.cumsum(p.a_size[a]), np.cumsum(p.b_size[b])
        cuts = np.union1d(a_ends, b_ends)
        both = np.intersect1d(a_ends, b_ends, assume_unique=True)
        # Every stretch between two cuts is one link; every stretch between two common cuts is one group.
        link_a, link_b = a[np.searchsorted(a_ends, cuts)], b[np.searchsorted(b_ends, cuts)]
        group_of = np.searchsorted(both, cuts)
        direct = (np.bincount(group_of)[group_of] == 1) & (p.same[link_a] == link_b)
        coded = np.where(direct, link_a, -1 - pair_number(link_a, link_b))

        def per_word(ends):
            return np.diff(np.searchsorted(ends, word_ends, side="right"), prepend=0)

        counted = np.stack([per_word(a_ends), per_word(b_ends), per_word(both), per_word(cuts)], axis=1)
        a_stops = np.searchsorted(a_ends, both, side="right").tolist()
        b_stops = np.searchsorted(b_ends, both, side="right").tolist()
        a_text, b_text = list(map(p.a_text.__getitem__, a.tolist())), list(map(p.b_text.__getitem__, b.tolist()))
        written, i, j = [], 0, 0
        for i2, j2 in zip(a_stops, b_stops, strict=True):
            if i2 == i + 1 and j2 == j + 1:
                written.append(f"{a_text[i]}|{b_text[j]}")
            else:
                written.append(f"{','.join(a_text[i:i2])}|{','.join(b_text[j:j2])}")
            i, j = i2, j2
        link = group = 0
        for word, counts in zip(words, counted.tolist(), strict=True):
            self._add(word, tuple(counts), ";".join(written[group : group + counts[2]]), coded[link : link + counts[3]], lossless=True)
            group, link = group + counts[2], link + counts[3]

    def of(self, texts: list[str | None]) -> list[list[int]]:
        """Numbers of the words of each text."""
        if len(self.counts) > REMEMBERED:
            self.clear()
        get = self.number.get
        rows, missing = [], {}
        for text in texts:
            for cut in (str.split, _CUT.split) if text else ():
                words = text.split(" ") if cut is str.split else cut(text)
                row = list(map(get, words))
                gaps = [i for i, v in enumerate(row) if v is None] if None in row else []
                if not any(_edged(words[i]) for i in gaps):
                    break
            if not text:
                row, gaps, words = [], [], []
            missing.update((words[i], None) for i in gaps)
            rows.append((row, [(i, words[i]) for i in gaps]))
        fresh = self.learn(list(missing))
        for row, gaps in rows:
            for i, word in gaps:
                row[i] = fresh[word]
        # White space at an end shows that a text is not to be cut at every blank, so such words stay unknown.
        self.number.update((w, n) for w, n in fresh.items() if not _edged(w))
        return [row for row, _ in rows]


def _squeezed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _expanded(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), "<i4") if n else np.zeros(0, np.int32)


def align_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per block of documents, stored: what its documents have of their own, their words, the links of these words and
    the pairs of irregular groups with their counts; and one row per task with ``vector``, counts of the groups in the array."""

    def blocks(batches):
        vocabularies = pair(a_path, b_path)
        words = Words(vocabularies)
        vector = np.zeros(len(vocabularies.a_bytes), np.int64)
        number, kind = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in text_slices(batch, "text", BLOCK_BYTES):
                yield block(part, words, vector, number, kind)
                number += 1
        if kind is not None:
            yield row(kind, vector=packed_vector(vector))

    def block(part, words, vector, number, kind):
        rows = words.of(part.column("text").to_pylist())
        lossless = words.lossless
        rows = [r if all(map(lossless.__getitem__, r)) else [] for r in rows]
        n_words = np.array([len(r) for r in rows], np.int64)
        used, local = np.unique(np.concatenate([np.zeros(0, np.int64), *map(np.asarray, rows)]).astype(np.int64), return_inverse=True)
        counts = np.array([words.counts[u] for u in used.tolist()], np.int64).reshape(-1, 4)
        before = np.concatenate([[0], np.cumsum(n_words)])
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(counts[local], axis=0)])
        of_docs = np.diff(sums[before], axis=0)
        links = np.concatenate([np.zeros(0, np.int64), *[words.links[u] for u in used.tolist()]])
        times = np.repeat(np.bincount(local, minlength=len(used)), counts[:, 3])
        direct = links >= 0
        vector += np.bincount(links[direct], times[direct], minlength=len(vector)).astype(np.int64)
        pairs, slots = np.unique(-1 - links[~direct], return_inverse=True)
        links[~direct] = -1 - slots
        written = words.groups
        hashes = [hashlib.sha256(";".join(map(written.__getitem__, r)).encode()).hexdigest() if r else "" for r in rows]
        return row(
            kind,
            block=number,
            doc_ids=part.column("doc_id").to_pylist(),
            **dict(zip(COUNTS, of_docs.T.tolist(), strict=True)),
            hashes=hashes,
            doc_words=n_words.tolist(),
            words=_squeezed(local),
            word_links=_squeezed(counts[:, 3]),
            links=_squeezed(links),
            n_words=len(used),
            pairs=pairs.tolist(),
            pair_counts=np.bincount(slots, times[~direct], minlength=len(pairs)).astype(np.int64).tolist(),
        )

    def row(kind, **values):
        return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema(kind)], schema=schema(kind))

    def schema(kind):
        numbers = pa.list_(pa.int64())
        return pa.schema(
            [
                ("block", pa.int64()),
                ("doc_ids", pa.list_(kind)),
                *[(c, numbers) for c in COUNTS],
                ("hashes", pa.list_(pa.string())),
                ("doc_words", numbers),
                ("words", pa.binary()),
                ("word_links", pa.binary()),
                ("links", pa.binary()),
                ("n_words", pa.int64()),
                ("pairs", numbers),
                ("pair_counts", numbers),
                ("vector", pa.binary()),
            ]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"block long, doc_ids array<{kind}>, {', '.join(f'{c} array<long>' for c in COUNTS)}, hashes array<string>, doc_words array<long>"
    columns += ", words binary, word_links binary, links binary, n_words long, pairs array<long>, pair_counts array<long>, vector binary"
    return stored(docs.select("doc_id", "text").mapInArrow(blocks, columns), "aligned")


class PairCounts:
    """Counts of all id pairs: those of the array in one vector, the others in a table."""

    def __init__(self, aligned: DataFrame, a_path: str, b_path: str) -> None:
        vocabularies = pair(a_path, b_path)
        counted = sum_vectors(aligned, "vector")
        direct = np.zeros(len(vocabularies.a_bytes), np.int64) if counted is None else counted.copy()
        each = aligned.where("block IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("p"))
        irregular = stored(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_counts").alias("n")), "irregular-pairs")
        a, b = F.shiftright("pair", _B_BITS), F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1))

        # The same pair may also occur inside an irregular group. At most one row per id of the first vocabulary is on the array.
        def on_array(batches):
            same = pair(a_path, b_path).same
            for batch in batches:
                pairs = batch.column("pair").to_numpy()
                yield batch.filter(pa.array(same[pairs >> _B_BITS] == (pairs & (1 << _B_BITS) - 1)))

        for row in irregular.mapInArrow(on_array, irregular.schema).collect():
            direct[row["pair"] >> _B_BITS] += row["n"]
        best = np.zeros(len(vocabularies.b_bytes), np.int64)
        for row in irregular.groupBy(b.alias("b")).agg(F.max("n").alias("n")).collect():
            best[row["b"]] = row["n"]
        known = vocabularies.same >= 0
        np.maximum.at(best, vocabularies.same[known], direct[known])
        self.same, self.direct, self.best = vocabularies.same, direct, best

        def totals(batches):
            for batch in batches:
                pairs, n = batch.column("pair").to_numpy(), batch.column("n").to_numpy()
                a, b = pairs >> _B_BITS, pairs & (1 << _B_BITS) - 1
                n = np.where(self_same[a] == b, self_direct[a], n)
                yield pa.RecordBatch.from_arrays([batch.column("pair"), pa.array(n), pa.array(n == self_best[b])], ["pair", "n", "best"])

        self_same, self_direct, self_best = self.same, direct, best
        self.irregular = irregular.mapInArrow(totals, "pair long, n long, best boolean")


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every document."""
    ship(docs.sparkSession)
    aligned = align_blocks(docs, a_path, b_path)
    counts = PairCounts(aligned, a_path, b_path)
    blocks = aligned.where("block IS NOT NULL").drop("vector", "pair_counts")
    asked = blocks.select("block", F.posexplode("pairs").alias("slot", "pair"))
    # At most as many values come back to a block as it has pairs.
    told = asked.join(counts.irregular, "pair").groupBy("block").agg(F.collect_list(F.struct("slot", "n", "best")).alias("told"))
    whole = blocks.withColumn("n_pairs", F.size("pairs").cast("long")).drop("pairs").join(told, "block", "left")
    whole = whole.select("*", *[F.col(f"told.{c}").alias(f"told_{c}") for c in ("slot", "n", "best")]).drop("told", "block")
    same, direct, best = counts.same, counts.direct, counts.best
    kind = docs.schema["doc_id"].dataType.simpleString()

    def documents(batches):
        is_best = (same >= 0) & (direct == best[same])
        for batch in batches:
            for i in range(batch.num_rows):
                yield of_block({name: batch.column(name)[i] for name in batch.schema.names}, batch.schema.field("doc_ids").type.value_type, is_best)

    def of_block(b, doc_kind, is_best):
        n, is_top = np.zeros(b["n_pairs"].as_py(), np.int64), np.zeros(b["n_pairs"].as_py(), bool)
        if b["told_slot"].is_valid:
            slots = b["told_slot"].values.to_numpy()
            n[slots], is_top[slots] = b["told_n"].values.to_numpy(), b["told_best"].values.to_numpy(zero_copy_only=False)
        per_word = _expanded(b["word_links"].as_py(), b["n_words"].as_py())
        links = _expanded(b["links"].as_py(), int(per_word.sum()))
        on_array = links >= 0
        values, tops = np.zeros(len(links) + 1, np.int64), np.zeros(len(links) + 1, np.int64)
        values[:-1][on_array], tops[:-1][on_array] = direct[links[on_array]], is_best[links[on_array]]
        values[:-1][~on_array], tops[:-1][~on_array] = n[-1 - links[~on_array]], is_top[-1 - links[~on_array]]
        ends = np.concatenate([[0], np.cumsum(b["doc_words"].values.to_numpy())])
        words = _expanded(b["words"].as_py(), int(ends[-1]))
        starts = np.concatenate([[0], np.cumsum(per_word)])
        sums = [np.diff(np.concatenate([[0], np.cumsum(v[:-1])])[starts])[words] for v in (values, tops)]
        count_sum, n_best = (np.diff(np.concatenate([[0], np.cumsum(s)])[ends]) for s in sums)
        columns = [b["doc_ids"].values, *[b[c].values for c in COUNTS], pa.array(n_best), pa.array(count_sum), b["hashes"].values]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"])

    columns = f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, n_best long, count_sum long, groups_sha256 string"
    return whole.mapInArrow(documents, columns)
