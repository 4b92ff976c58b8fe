import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellspark.llm import packing, token_counts
from cellspark.llm.units import units_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd_texts():
    random.seed(7)
    parts = [*"abcZé 中'sé  \n\t\r\x0b\x1c\x85\xa0　1²٣_!.<|>ß", "<|endoftext|>", "'ll", " the", "\U0001f600"]
    return ["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(3000)] + ["a" * 3000, " " * 200, "", "ab" * 999]


def test_counts_equal_the_library(library, odd_texts):
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in odd_texts]
    assert token_counts.MergeCounter(PATH).count(odd_texts) == expected


def test_ids_equal_the_library(library, odd_texts):
    encoder = packing.Encoder(PATH)
    for text, data in zip(odd_texts, encoder.documents(odd_texts), strict=True):
        assert np.frombuffer(data, encoder.kind).tolist() == [*library.encode(text, add_special_tokens=False).ids, packing.END]


def test_units_lose_nothing(odd_texts):
    assert all("".join(units_of(t)) == t for t in odd_texts)


def test_forgetting_changes_nothing(library, odd_texts, monkeypatch):
    monkeypatch.setattr("cellspark.llm.units.REMEMBERED", 5)
    monkeypatch.setattr("cellspark.llm.units.CHARACTERS", 50)
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in odd_texts]
    assert token_counts.MergeCounter(PATH).count(odd_texts) == expected


def test_count_tokens(odd, empty, library):
    rows = token_counts.count_tokens(odd, PATH, 1024).collect()
    texts = odd.collect()
    assert len(rows) == len(texts)
    for row, doc in zip(rows, texts, strict=True):
        text = doc["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert tuple(row) == (doc["doc_id"], len(text.encode()), n, n > 1024)
    assert token_counts.count_tokens(empty, PATH).count() == 0


@pytest.mark.parametrize("size", [7, 64, 2048])
def test_packing(odd, library, size):
    rows = packing.pack(odd.repartition(3), PATH, size).collect()
    rows.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    at = 0
    for row in rows:
        assert row["sequence_id"] * size + row["offset"] == at and 0 < row["length"] <= size - row["offset"]
        at += row["length"]
    pieces = {}
    for row in rows:
        pieces.setdefault(row["doc_id"], []).append((row["start"], row["length"], row["ids_crc32"], row["doc_tokens"]))
    for doc in odd.distinct().collect():
        ids = np.array([*library.encode(doc["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        times = 2 if doc["doc_id"] == 0 else 1
        own = sorted(pieces[doc["doc_id"]])
        assert sum(p[1] for p in own) == times * len(ids)
        assert all(n == len(ids) and crc == zlib.crc32(ids[s : s + k].tobytes()) for s, k, crc, n in own)


def test_packing_nothing(empty):
    assert packing.pack(empty, PATH).collect() == []
