import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellspark.llm import binary_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(7)
    parts = [*"abcZé 中'sé  \n\t\r\x0b\x1c\x85\xa0　1²٣_!.<|>ßİΣς,;&", "<|endoftext|>", "<|ENDOFTEXT|>", "'ll", " the", "\U0001f600", "é"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(4000)] + ["a" * 3000, " " * 200, "", "ab" * 999, None]


@pytest.mark.parametrize("remembered", [5, 1_000_000])
def test_ids_equal_the_library(library, odd_texts, monkeypatch, remembered):
    monkeypatch.setattr(binary_ids, "REMEMBERED", remembered)
    encoder = binary_ids.WordEncoder(PATH)
    for first in range(0, len(odd_texts), 700):
        texts, at = odd_texts[first : first + 700], 0
        ids, n = encoder.documents(pa.array(texts, pa.string()))
        for text, k in zip(texts, n, strict=True):
            assert ids[at : at + k].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, binary_ids.END], text
            at += k


def cost_of_plain_huffman(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def least_cost(weights, longest):
    """By trying all length vectors of a small alphabet."""
    best = None
    weights = sorted(weights, reverse=True)

    def extend(lengths, room):
        nonlocal best
        if len(lengths) == len(weights):
            cost = sum(w * n for w, n in zip(weights, lengths, strict=True))
            best = cost if best is None else min(best, cost)
            return
        for n in range(lengths[-1] if lengths else 1, longest + 1):
            if room >= 2 ** (longest - n):
                extend([*lengths, n], room - 2 ** (longest - n))

    extend([], 2**longest)
    return best


def test_code_lengths():
    rng = np.random.default_rng(1)
    for n, longest in [(300, 24), (40, 24), (5, 8)]:
        counts = (rng.pareto(1.0, n) * 10 + 1).astype(np.int64)
        assert int((binary_ids.code_lengths(counts, longest) * counts).sum()) == cost_of_plain_huffman(counts)
    for weights in ([1, 1, 2, 4, 8, 16], [5, 5, 5, 5, 5], [1, 100, 1, 100, 3]):
        lengths = binary_ids.code_lengths(np.array(weights), 3)
        assert lengths.max() <= 3 and int((lengths * weights).sum()) == least_cost(weights, 3)
    assert binary_ids.code_lengths(np.array([0, 7, 0]), 3).tolist() == [0, 1, 0]
    assert binary_ids.code_lengths(np.zeros(0, np.int64)).tolist() == []
    with pytest.raises(ValueError):
        binary_ids.code_lengths(np.ones(9), 3)


@pytest.mark.parametrize(("size", "longest"), [(1, 3), (2, 3), (300, 9), (50_000, 16), (50_000, 24)])
def test_codes_and_lanes(size, longest):
    rng = np.random.default_rng(size)
    counts = (rng.pareto(1.0, size) * 10).astype(np.int64) + (size < 10)
    lengths = binary_ids.code_lengths(counts, longest)
    n = rng.integers(1, 900, 30)
    ids = rng.choice(np.flatnonzero(counts), int(n.sum()))
    bits, offsets = binary_ids.encode_documents(ids, n, lengths, binary_ids.canonical_codes(lengths), 64)
    at = 0
    for data, places, k in zip(bits, offsets, n, strict=True):
        starts = np.frombuffer(places, "<u8").astype(np.int64)
        lanes = np.diff([*range(0, k, 64), k])
        assert binary_ids.decode_lanes(data, starts, lanes, binary_ids.decoding_table(lengths, longest)).tolist() == ids[at : at + k].tolist()
        at += k


def expected(library, docs):
    rows, start = [], 0
    for doc, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def test_round_trip(shipped, library, odd_texts):
    docs = [(i * 7 % 4001, t) for i, t in enumerate(odd_texts[-900:])] + [(9000, "long words " * 30000)]
    table = shipped.createDataFrame(docs, "doc_id long, text string").withColumns({"part": F.lit("x"), "ids": F.lit("x"), "n": F.lit(1)}).repartition(5)
    read = binary_ids.round_trip(table, PATH)
    got = sorted(tuple(r) for r in read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c")).collect())
    assert got == expected(library, sorted(docs, key=lambda d: d[0]))


def test_files_and_hot_ids(shipped, tmp_path, library):
    """Rows without an id come first, and so many of one id that they fill several ranges."""
    docs = [(None, f"no id {i}") for i in range(50)] + [(3, f"the same id {i % 40}") for i in range(200)] + [(i, f"others {i}") for i in range(4, 60)]
    folder = f"{tmp_path}/files"
    binary_ids.write(shipped.createDataFrame(docs, "doc_id long, text string"), PATH, folder, block_ids=300)
    blocks = shipped.read.parquet(f"{folder}/blocks")
    assert blocks.where(F.array_contains("doc_ids", 3)).select("part").distinct().count() > 1
    assert blocks.where("n_ids > 300 + 60").count() == 0 and blocks.count() > 4
    rows = binary_ids.read(shipped, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((d for d, _ in docs), key=lambda d: (d is not None, d))
    at = 0
    for row in rows:
        assert row["start"] == at
        at += row["n_tokens"]
    own = sorted(np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in docs)
    assert sorted(bytes(r["ids"]) for r in rows) == own


def test_no_documents(empty):
    assert binary_ids.round_trip(empty, PATH).collect() == []
