import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellspark.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    parts = [*"abcZé 中'sé  \n\t\r\x0b\x1c\x85\xa0　1²٣_!.<|>ß\0", "<|endoftext|>", "<s>", "<0x41>", "'ll", " the", "\U0001f600", " under", "stand", "ings"]
    odd = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(1200)]
    return [*odd, *odd[:50], "a" * 3000, " " * 200, "", None, "real ▁ sign", "x▁", "ab " * 9999, " lead", "trail ", "word\n", "\n word"]


def tokens_of(text, a, b):
    data = (" " + (text or "")).encode()
    byte_of = {c: x for x, c in alignment._byte_alphabet().items()}
    a_ids, b_ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
    a_bytes = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if not text or b"".join(a_bytes) != data or b"".join(b_bytes) != data:
        return [], []
    return [(i, len(x)) for i, x in zip(a_ids, a_bytes, strict=True)], [(i, len(x)) for i, x in zip(b_ids, b_bytes, strict=True)]


def brute(texts):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    aligned, counts = [], Counter()
    for text in texts:
        left, right = tokens_of(text, a, b)
        groups, links, i, j, x, y = [], [], 0, 0, 0, 0
        group = ([], [])
        while i < len(left):
            links.append((left[i][0], right[j][0]))
            stop = min(x + left[i][1], y + right[j][1])
            if stop == x + left[i][1]:
                group[0].append(left[i][0])
                x, i = stop, i + 1
            if stop == y + right[j][1]:
                group[1].append(right[j][0])
                y, j = stop, j + 1
            if x == y == stop:
                groups.append(group)
                group = ([], [])
        counts.update(links)
        aligned.append((left, right, groups, links))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    rows = []
    for left, right, groups, links in aligned:
        written = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        hashed = hashlib.sha256(written.encode()).hexdigest() if links else ""
        rows.append((len(left), len(right), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), hashed))
    return rows


@pytest.mark.parametrize("block_bytes", [300, 2_000_000])
def test_alignment_equals_brute_force(shipped, texts, monkeypatch, block_bytes):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    table = shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"block": F.lit("x"), "n_a": F.lit("x")}).repartition(3)
    got = [tuple(r)[1:] for r in sorted(alignment.align(table, A, B).collect())]
    assert got == brute(texts)


def test_forgetting_changes_nothing(texts, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    words, kept = alignment.Words(alignment.pair(A, B)), alignment.Words(alignment.pair(A, B))
    kept_rows = []
    monkeypatch.setattr(alignment, "REMEMBERED", 1 << 30)
    for text in texts[:300]:
        kept_rows.append([kept.groups[u] for u in kept.of([text])[0]])
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    for text, expected in zip(texts[:300], kept_rows, strict=True):
        assert [words.groups[u] for u in words.of([text])[0]] == expected


def test_pair_counts(shipped, texts):
    """Vector and table together hold every link once; ids on the array have the same bytes."""
    table = shipped.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    aligned = alignment.align_blocks(table, A, B)
    counts = alignment.PairCounts(aligned, A, B)
    vocabularies = alignment.pair(A, B)
    assert all(vocabularies.a_bytes[i] == vocabularies.b_bytes[n] for i, n in enumerate(vocabularies.same.tolist()) if n >= 0)
    table_pairs = {(r["pair"] >> 24, r["pair"] & (1 << 24) - 1): r["n"] for r in counts.irregular.collect()}
    on_array = {(int(i), int(counts.same[i])): int(counts.direct[i]) for i in np.flatnonzero(counts.direct)}
    assert all(table_pairs[k] == on_array[k] for k in table_pairs.keys() & on_array.keys())
    assert sum((on_array | table_pairs).values()) == sum(r[3] for r in brute(texts))


def test_odd_tables(odd, empty):
    got = sorted(tuple(r)[1:] for r in alignment.align(odd, A, B).collect())
    assert got == sorted(brute([r["text"] for r in odd.collect()]))
    assert alignment.align(empty, A, B).collect() == []
