"""Token ids of all documents as files of canonical Huffman codes, and reading them back.

The first pass tokenizes and stores every document's ids, and counts all ids in one vector of the vocabulary's
length. Code lengths follow from the counts by package-merge, with no code over a stated length; codes are canonical,
so a file holds lengths only. Every document becomes a string of codes that begins on a whole byte, with the bit
offset of every 256th id. Documents are put in order by range, and written in blocks that end with a document.

    codebook/   one row: ``lengths`` (a byte per id, 0 where an id has no code), ``longest``, ``spacing``
    blocks/     one row per block: ``part``, ``block``, ``doc_ids``, ``doc_tokens``, ``doc_bytes``, ``offsets``, ``bits``

A block is decoded without any other: all its checkpoints at once, one id each a step, by one table over the longest code.

Defined cases: a null or empty text is the end mark alone; texts of any length are encoded whole, and their parts between
checkpoints decoded side by side; documents without an id come first; rows that repeat an id all stay, in the order of
their ids' bytes; an empty table gives no blocks and an empty codebook; other columns are not read. ``part`` numbers ranges of
``doc_id`` in ascending order, so (``part``, ``block``) is the order of the file.
"""

from __future__ import annotations

import functools
import os
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellspark.llm.common import packed_vector, ship, slices, stored, sum_vectors, text_slices
from cellspark.session import scratch_path

END = 2
LONGEST_CODE = 18
SPACING = 256
# A block takes documents until it holds so many ids.
BLOCK_IDS = 1 << 16

# A worker remembers at most so many words; then it starts anew.
REMEMBERED = 1_000_000
WORDS_AT_ONCE = 400

# Punctuation that stays one piece with its like and is no part of a contraction.
_TAILS = ".,;:!?*$%&#"


def _plain(word: str) -> bool:
    """Letters of scripts whose cases and compositions are plain."""
    return word.isalpha() and (word.isascii() or max(word) < "ɐ" and "İ" not in word)


class WordEncoder:
    """Ids of whole texts by the library, for vocabularies of words with ends that drop white space.

    No token reaches over a blank, so texts are cut there and every word is encoded once. A word of plain letters, and the
    punctuation that may follow it, are single pieces of the vocabulary's own cut; many are encoded end to end, and their
    last tokens, which carry the end of a word, tell them apart. All other words go to the library alone.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.size = max(vocabulary.values(), default=END) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.ends_word = np.zeros(self.size, bool)
        self.ends_word[[number for entry, number in vocabulary.items() if entry.endswith("</w>")]] = True
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # Where one of these holds a blank, words are no units.
        self.whole_texts = any(re.search(r"\s", s) for s in self.special)
        self.known: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}

    def _alone(self, words: list[str]) -> list[bytes]:
        made = []
        for i in range(0, len(words), 2000):
            made += [np.array(e.ids, self.kind).tobytes() for e in self.library.encode_batch_fast(words[i : i + 2000], add_special_tokens=False)]
        return made

    def _encode_pieces(self, words: Iterable[str]) -> None:
        new = [w for w in set(words) if w not in self.pieces]
        for at in range(0, len(new), 64 * WORDS_AT_ONCE):
            groups = [new[i : i + WORDS_AT_ONCE] for i in range(at, min(at + 64 * WORDS_AT_ONCE, len(new)), WORDS_AT_ONCE)]
            encodings = self.library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
            for group, encoding in zip(groups, encodings, strict=True):
                ids = np.array(encoding.ids, self.kind)
                stops = (np.flatnonzero(self.ends_word[ids]) + 1) * self.kind.itemsize
                if len(stops) != len(group) or stops[-1] != ids.nbytes:
                    self.pieces.update(zip(group, self._alone(group), strict=True))
                    continue
                data, begin = ids.tobytes(), 0
                for word, stop in zip(group, stops.tolist(), strict=True):
                    self.pieces[word], begin = data[begin:stop], stop

    def _learn(self, words: set[str]) -> None:
        letters, followed, alone = [], [], []
        for word in words:
            if _plain(word):
                letters.append((word, word.lower()))
            elif word[-1] in _TAILS and _plain(core := word.rstrip(_TAILS)):
                followed.append((word, core.lower(), word[len(core) :]))
            else:
                alone.append(word)
        self._encode_pieces([low for _, low in letters])
        self._encode_pieces([piece for _, low, tail in followed for piece in (low, tail)])
        pieces = self.pieces
        self.known.update((word, pieces[low]) for word, low in letters)
        self.known.update((word, pieces[low] + pieces[tail]) for word, low, tail in followed)
        self.known.update(zip(alone, self._alone(alone), strict=True))

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end mark, one text after the other; and how many each has."""
        end = np.array([END], self.kind).tobytes()
        if self.whole_texts:
            each = self._alone([t or "" for t in texts.to_pylist()])
        else:
            if len(self.known) > REMEMBERED:
                self.known, self.pieces = {"": b""}, {}
            each = self._by_word([(t.replace("\n", " ") if "\n" in t else t).split(" ") if t else [] for t in texts.to_pylist()])
        n = np.array([len(ids) for ids in each], np.int64) // self.kind.itemsize + 1
        return np.frombuffer(b"".join(x for ids in each for x in (ids, end)), self.kind), n

    def _by_word(self, texts: list[list[str]]) -> list[bytes]:
        values = [list(map(self.known.get, words)) for words in texts]
        gaps = [[i for i, v in enumerate(row) if v is None] if None in row else [] for row in values]
        self._learn({words[i] for words, at in zip(texts, gaps, strict=True) for i in at})
        for words, row, at in zip(texts, values, gaps, strict=True):
            for i in at:
                row[i] = self.known[words[i]]
        return [b"".join(row) for row in values]


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process."""
    return WordEncoder(path)


def binaries(ids: np.ndarray, n: np.ndarray) -> pa.Array:
    """Ids of documents, ``n`` each, as one binary value a document."""
    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int64) * ids.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids))]).cast(pa.binary())


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n`` and ``ids`` of each document, and in the last row of a task ``counts`` of all its ids; stored."""

    def encode(batches):
        encode = encoder(path)
        counts = np.zeros(encode.size, np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in text_slices(batch, "text", 2_000_000):
                ids, n = encode.documents(part.column("text"))
                counts += np.bincount(ids, minlength=encode.size)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), binaries(ids, n), pa.nulls(len(n), pa.binary())], ["doc_id", "n", "ids", "counts"]
                )
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([packed_vector(counts)], pa.binary())],
                ["doc_id", "n", "ids", "counts"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, n long, ids binary, counts binary"), "token-ids")


def code_lengths(counts: np.ndarray, longest: int = LONGEST_CODE) -> np.ndarray:
    """The length of every id's code, at most ``longest``, of least total length; 0 for ids that do not occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n > 1 << longest:
        raise ValueError(f"{n} ids need codes longer than {longest} bits")
    if n < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.int64)
    packages = np.zeros(0, np.int64)
    single = []
    for _ in range(longest):
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")
        single.append(order < n)
        pairs = both[order][: len(both) // 2 * 2]
        packages = pairs[::2] + pairs[1::2]
    taken = 2 * n - 2
    for of_level in reversed(single):
        singles = int(of_level[:taken].sum())
        lengths[used[:singles]] += 1
        taken = 2 * (taken - singles)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    following = 0
    for length in range(1, int(lengths.max(initial=0)) + 1):
        ids = np.flatnonzero(lengths == length)
        following <<= 1
        codes[ids] = np.arange(following, following + len(ids), dtype=np.uint64)
        following += len(ids)
    return codes


def decoding_table(lengths: np.ndarray, longest: int) -> np.ndarray:
    """For every bit string of the longest length the id that it begins with, and in the top byte the length of its code."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    entries = order.astype(np.uint32) | lengths[order].astype(np.uint32) << 24
    table = np.zeros(1 << longest, np.uint32)
    filled = np.repeat(entries, 1 << (longest - lengths[order].astype(np.int64)))
    table[: len(filled)] = filled
    return table


def encode_documents(ids: np.ndarray, n: np.ndarray, lengths: np.ndarray, codes: np.ndarray, spacing: int = SPACING) -> tuple[list[bytes], list[bytes]]:
    """Codes of each document (``n`` ids each, at least one) from a whole byte on, and the bit offset of every ``spacing``-th id."""
    size = lengths[ids].astype(np.int64)
    first = np.cumsum(n) - n
    before = np.cumsum(size) - size
    n_bytes = (np.add.reduceat(size, first) + 7) // 8
    at_byte = np.cumsum(n_bytes) - n_bytes
    at = before + np.repeat(8 * at_byte - before[first], n)
    word, shift = at >> 5, (64 - (at & 31) - size).astype(np.uint64)
    placed = codes[ids] << shift
    new = np.flatnonzero(np.diff(word, prepend=-1))
    words = np.zeros(int(word[-1]) + 2, np.uint64)
    words[word[new]] = np.bitwise_or.reduceat(placed >> np.uint64(32), new)
    words[word[new] + 1] |= np.bitwise_or.reduceat(placed & np.uint64(0xFFFFFFFF), new)
    data = words.astype(">u4").tobytes()
    bits = [data[a : a + k] for a, k in zip(at_byte.tolist(), n_bytes.tolist(), strict=True)]
    offsets = [(at[f : f + k : spacing] - at[f]).astype("<u8").tobytes() for f, k in zip(first.tolist(), n.tolist(), strict=True)]
    return bits, offsets


def decode_lanes(bits: bytes, starts: np.ndarray, n: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Ids of lanes of ``n`` ids that begin at bits ``starts``, one lane after the other."""
    data = np.frombuffer(bits + bytes(4), np.uint8).astype(np.uint32)
    windows = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    unused = np.uint32(32 - (len(table).bit_length() - 1))
    order = np.argsort(-n, kind="stable")
    at, first = starts[order].astype(np.int64), (np.cumsum(n) - n)[order]
    # How many lanes still have a k-th id.
    active = len(n) - np.searchsorted(np.sort(n), np.arange(int(n.max(initial=0))), side="right")
    made = np.zeros(int(n.sum()), np.uint32)
    for k, lanes in enumerate(active.tolist()):
        here = at[:lanes]
        entry = table[windows[here >> 3] << (here & 7).astype(np.uint32) >> unused]
        made[first[:lanes] + k] = entry & np.uint32(0xFFFFFF)
        here += entry >> np.uint32(24)
    return made


def _bounds(tokens: DataFrame, parts: int) -> list[tuple]:
    """The last key of each of ``parts`` ranges of documents: one row a range."""
    keys = tokens.select("doc_id", F.xxhash64("ids").alias("tie"))
    ranged = keys.repartitionByRange(parts, "doc_id", "tie").groupBy(F.spark_partition_id().alias("part"))
    last = ranged.agg(F.max(F.struct("doc_id", "tie")).alias("last")).select("last.*").orderBy("doc_id", "tie").collect()
    return [(r["doc_id"] is not None, r["doc_id"], r["tie"]) for r in last[:-1]]


def write(docs: DataFrame, path: str, folder: str, longest: int = LONGEST_CODE, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents, in ascending order of ``doc_id``, to ``folder``."""
    if not 1 <= longest <= 24:
        raise ValueError("codes of 1 to 24 bits can be read")
    spark = docs.sparkSession
    tokens = tokenize(docs, path)
    counts = sum_vectors(tokens, "counts")
    tokens = tokens.where("n IS NOT NULL").select("doc_id", "n", "ids")
    lengths = code_lengths(np.zeros(0, np.int64) if counts is None else counts, longest)
    codes = canonical_codes(lengths)
    spark.createDataFrame([(bytearray(lengths.tobytes()), longest, SPACING)], "lengths binary, longest int, spacing int").write.parquet(f"{folder}/codebook")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(tokens, parts)
    kind = docs.schema["doc_id"].dataType.simpleString()
    wide = np.dtype("<u2" if len(lengths) <= 1 << 16 else "<u4")

    def encode(batches):
        for batch in slices(batches, 32):
            doc_ids, ties = batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()
            # A null id has no value to compare, only its place before all others.
            part = [bisect_left(bounds, (d is not None, d, t)) for d, t in zip(doc_ids, ties, strict=True)]
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), wide)
            bits, offsets = encode_documents(ids, batch.column("n").to_numpy(), lengths, codes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(part, pa.int32()), batch.column("n"), pa.array(offsets, pa.binary()), pa.array(bits, pa.binary())],
                ["doc_id", "tie", "part", "n", "offsets", "bits"],
            )

    schema = f"doc_id {kind}, tie long, part int, n long, offsets binary, bits binary"
    coded = tokens.select("doc_id", F.xxhash64("ids").alias("tie"), "n", "ids").mapInArrow(encode, schema)
    in_order = coded.repartitionById(parts, "part").sortWithinPartitions("doc_id", "tie")
    blocks = f"part int, block long, begin long, n_ids long, doc_ids array<{kind}>, doc_tokens array<long>, doc_bytes array<long>, offsets binary, bits binary"
    in_order.mapInArrow(functools.partial(_blocks, block_ids), blocks).write.parquet(f"{folder}/blocks")


def _blocks(block_ids: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = begin = held = 0
    docs: list[tuple] = []
    kind = part = None

    def closed():
        doc_ids, n, offsets, bits = zip(*docs, strict=True)
        columns = [
            pa.array([part], pa.int32()),
            pa.array([block]),
            pa.array([begin]),
            pa.array([held]),
            pa.array([list(doc_ids)], pa.list_(kind)),
            pa.array([list(n)], pa.list_(pa.int64())),
            pa.array([[len(b) for b in bits]], pa.list_(pa.int64())),
            pa.array([b"".join(offsets)], pa.binary()),
            pa.array([b"".join(bits)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["part", "block", "begin", "n_ids", "doc_ids", "doc_tokens", "doc_bytes", "offsets", "bits"])

    for batch in batches:
        kind = batch.schema.field("doc_id").type
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "part", "n", "offsets", "bits")]
        for doc, part, n, offsets, bits in zip(*columns, strict=True):
            docs.append((doc, n, offsets, bits))
            held += n
            if held >= block_ids:
                yield closed()
                docs, block, begin, held = [], block + 1, begin + held, 0
    if docs:
        yield closed()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (unsigned 32-bit, little-endian) from the files."""
    book = spark.read.parquet(f"{folder}/codebook").first()
    lengths = np.frombuffer(bytes(book["lengths"]), np.uint8)
    longest, spacing = book["longest"], book["spacing"]
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches):
        table = decoding_table(lengths, longest)
        for batch in slices(batches, 16):
            n = np.concatenate([np.zeros(0, np.int64), *[b.values.to_numpy() for b in batch.column("doc_tokens")]])
            n_bytes = np.concatenate([np.zeros(0, np.int64), *[b.values.to_numpy() for b in batch.column("doc_bytes")]])
            bits = b"".join(batch.column("bits").to_pylist())
            offsets = np.frombuffer(b"".join(batch.column("offsets").to_pylist()), "<u8").astype(np.int64)
            lanes = -(-n // spacing)
            starts = offsets + np.repeat(8 * (np.cumsum(n_bytes) - n_bytes), lanes)
            in_lane = np.full(len(starts), spacing, np.int64)
            in_lane[np.cumsum(lanes) - 1] = n - (lanes - 1) * spacing
            ids = decode_lanes(bits, starts, in_lane, table).astype("<u4", copy=False)
            ends = np.cumsum(n)
            docs_in_block = [len(b) for b in batch.column("doc_ids")]
            first = np.cumsum(docs_in_block) - docs_in_block
            begin = batch.column("begin").to_numpy() - (ends - n)[first] if len(ends) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("part").to_numpy(), docs_in_block)),
                    pa.concat_arrays([b.values for b in batch.column("doc_ids")]) if len(ends) else pa.array([], batch.schema.field("doc_ids").type.value_type),
                    pa.array(np.repeat(begin, docs_in_block) + ends - n),
                    pa.array(n),
                    binaries(ids, n),
                ],
                ["part", "doc_id", "begin", "n_tokens", "ids"],
            )

    decoded = blocks.select("part", "begin", "doc_ids", "doc_tokens", "doc_bytes", "offsets", "bits").mapInArrow(
        decode, f"part int, doc_id {kind}, begin long, n_tokens long, ids binary"
    )
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("total"))
    # One row per range of documents is put in line and joined back.
    bases = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    return decoded.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Write the documents' ids to the shared folder and read them back."""
    ship(docs.sparkSession)
    folder = scratch_path(docs.sparkSession, "binary-ids")
    write(docs, path, folder)
    return read(docs.sparkSession, folder)
