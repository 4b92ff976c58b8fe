"""Packing: all documents laid end to end and cut into windows of fixed size.

The first pass tokenizes and writes every document's ids with its place inside its partition. One total per
partition is then summed up in order of the partitions, which gives every document its place in the whole; the
second pass cuts at multiples of the window, and a document that crosses a boundary gets one record per piece.
Only the last window is not full, so only it is padded (not at all where its length is a power of two).

Defined cases: a null or empty text is the end mark alone; an empty table gives no pieces; a text of any length
is cut like the others; repeated rows are packed as often as they occur; other columns are not read. Windows
follow the order in which the first pass read the documents.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspark.llm.common import slices, stored
from cellspark.llm.units import Units

END = 1


class Encoder:
    """Ids of whole texts by the library, unit by unit; 16-bit where the vocabulary allows it.

    New units are encoded many at a time, end to end, which the library does much faster than one by one. The
    bytes that each id stands for show where a unit ends.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        # In vocabularies over bytes every character of an entry is one byte; added entries are plain text.
        vocabulary = self.library.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for entry, number in vocabulary.items():
            self.bytes[number] = len(entry)
        for number, token in self.library.get_added_tokens_decoder().items():
            self.bytes[number] = len(token.content.encode())
        self.units = Units(self._encode)

    def _encode(self, units: list[str]) -> list[bytes]:
        results: list[bytes | None] = [None] * len(units)
        # A unit that starts with one space and ends in something else may be followed by another such unit.
        joined = [i for i, u in enumerate(units) if u[:1] == " " and u[1:] and not (u[1].isspace() or u[-1].isspace())]
        groups = [joined[i : i + 500] for i in range(0, len(joined), 500)]
        encoded = self.library.encode_batch_fast(["".join(units[i] for i in group) for group in groups], add_special_tokens=False)
        for group, encoding in zip(groups, encoded, strict=True):
            ids = np.array(encoding.ids, self.kind)
            ends = np.cumsum(self.bytes[ids])
            wanted = np.cumsum([len(units[i].encode()) for i in group])
            stops = np.searchsorted(ends, wanted) + 1
            if stops[-1] == len(ids) and np.array_equal(ends[stops - 1], wanted):
                data, begin = ids.tobytes(), 0
                for i, stop in zip(group, (stops * self.kind.itemsize).tolist(), strict=True):
                    results[i], begin = data[begin:stop], stop
        alone = [i for i, r in enumerate(results) if r is None]
        for i, encoding in zip(alone, self.library.encode_batch_fast([units[i] for i in alone], add_special_tokens=False), strict=True):
            results[i] = np.array(encoding.ids, self.kind).tobytes()
        return results

    def documents(self, texts):
        end = np.array([END], self.kind).tobytes()
        for values in self.units.of(texts):
            yield b"".join(values) + end


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``part``, ``begin`` (ids of the partition before it), ``n`` and ``ids``; written to the shared folder."""

    def encode(batches):
        part, begin = TaskContext.get().partitionId(), 0
        encode = encoder(path)
        width = encode.kind.itemsize
        for batch in slices(batches, 1024):
            ids = list(encode.documents(batch.column("text").to_pylist()))
            n = np.array([len(x) // width for x in ids], np.int64)
            ends = begin + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(ids), part, np.int32)), pa.array(ends - n), pa.array(n), pa.array(ids, pa.binary())],
                ["doc_id", "part", "begin", "n", "ids"],
            )
            begin = int(ends[-1]) if len(ids) else begin

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, part int, begin long, n long, ids binary"), "token-ids")


def place(tokens: DataFrame) -> DataFrame:
    """Adds ``at``, the number of ids before each document in the whole. One row per partition is joined back."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    bases = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    return tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("begin"))


def cut(placed: DataFrame, size: int) -> DataFrame:
    """One row per piece."""

    def pieces(batches):
        for batch in slices(batches, 1024):
            rows = []
            for doc, n, ids, at in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), batch.column("ids"), batch.column("at").to_pylist(), strict=True):
                data = ids.as_py()
                wide = memoryview(np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4").tobytes())
                start = 0
                while start < n:
                    offset = (at + start) % size
                    length = min(size - offset, n - start)
                    rows.append((doc, start, length, zlib.crc32(wide[4 * start : 4 * (start + length)]), n, (at + start) // size, offset))
                    start += length
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field("doc_id").type), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = placed.schema["doc_id"].dataType.simpleString()
    columns = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.select("doc_id", "n", "ids", "at").mapInArrow(pieces, f"doc_id {kind}, {columns}")


def pack(docs: DataFrame, path: str, size: int = 2048) -> DataFrame:
    """Pieces of all documents: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    return cut(place(tokenize(docs, path)), size)
