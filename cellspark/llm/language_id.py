"""Language identification by unigram pieces, summed over all segmentations.

Words are lower-cased runs of letters with the vocabulary's mark of a word's start. For every language each
piece of a fixed public vocabulary has a probability; a forward pass over the characters of a word sums the
probabilities of all ways to cut it into pieces, so no segmentation is preferred. Probabilities come from
expected piece counts (forward and backward passes over the distinct words of a bounded sample of labelled
texts), first with equal pieces, then with the probabilities of the round before.

Learning takes, of each language, the ``max_rows`` labelled rows with the smallest hashes of ids. Id, language and source are never
inputs of a prediction.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without labelled rows everything is
``und``; pieces may be as long as the vocabulary has them, and words of any length are summed whole, in blocks of 32
characters that hand their sums on; ties go to the language that sorts first; repeated rows
are predicted alike; other columns are not read.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cellspark.llm.common import smallest_hashes, stored

WORD = regex.compile(r"\p{L}+")
START = "▁"  # the vocabulary's mark of a word's start
LONGEST_PIECE = 16  # of the public vocabulary, for tests; the code takes that of the file, ``Pieces.longest``
PART = 32  # characters of a block; sums are scaled between blocks
UNKNOWN = 1e-5  # probability of a character in no known piece, in every language
REMEMBERED = 300_000  # blocks of words
PREDICTION = T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType())
_BASE = np.uint64(0x9E3779B97F4A7C15)
Found = list[list[tuple[int, np.ndarray, np.ndarray]]]


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return WORD.findall((text or "").lower())


class Pieces:
    """Pieces of a vocabulary file by length, found by rolling hashes of whole batches of words."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(library.get_piece_size()) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        texts = {i: library.id_to_piece(i) for i in usable}
        self.size = library.get_piece_size()
        self.longest = max(map(len, texts.values()), default=1)
        self.by_length = {}
        for length in range(1, self.longest + 1):
            ids = [i for i, t in texts.items() if len(t) == length]
            if ids:
                *_, hashes = self._hashes(np.array([[ord(c) for c in texts[i]] for i in ids], np.uint64), length)
                order = np.argsort(hashes[:, 0])
                self.by_length[length] = (hashes[order, 0], np.array(ids)[order])

    @staticmethod
    def _hashes(codes: np.ndarray, longest: int):
        """Hashes at every place, for each length in turn."""
        total = np.zeros(codes.shape, np.uint64)
        for length in range(1, min(longest, codes.shape[1]) + 1):
            total = total[:, : codes.shape[1] - length + 1] * _BASE + codes[:, length - 1 :] + np.uint64(1)
            yield total

    def found(self, codes: np.ndarray, places: int) -> Found:
        """At each of the first ``places``: the pieces that begin there, by length, as (words, pieces)."""
        result: Found = [[] for _ in range(places)]
        for length, wanted in enumerate(self._hashes(codes, self.longest), 1):
            if length not in self.by_length:
                continue
            hashes, ids = self.by_length[length]
            wanted = wanted[:, :places].T
            at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            start, word = np.nonzero(hashes[at] == wanted)
            piece = ids[at[start, word]]
            cuts = np.searchsorted(start, np.arange(places + 1))
            for place in np.unique(start):
                here = slice(cuts[place], cuts[place + 1])
                result[place].append((length, word[here], piece[here]))
        return result


@functools.cache
def pieces(path: str) -> Pieces:
    """One vocabulary per worker process."""
    return Pieces(path)


def _by_length(words: list[str]):
    """Words of equal length together: their places, and their characters with the start mark."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        text = "".join(START + words[i] for i in at)
        yield at, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(at), length + 1).astype(np.uint64)


def _push(alpha: np.ndarray, found: Found, probability: np.ndarray) -> None:
    """From each place to the ends of the pieces that begin there. alpha[place, word, language]."""
    for start, pieces_here in enumerate(found):
        alpha[start + 1] += alpha[start] * UNKNOWN
        for length, word, piece in pieces_here:
            alpha[start + length, word] += alpha[start, word] * probability[piece]


def _blocks(vocabulary: Pieces, codes: np.ndarray):
    """Blocks of places: the first one, and the pieces that begin in the block; they may end after it."""
    for first in range(0, codes.shape[1], PART):
        yield first, vocabulary.found(codes[:, first : first + PART + vocabulary.longest], min(PART, codes.shape[1] - first))


def _carried(before: np.ndarray, places: int, width: int, longest: int) -> np.ndarray:
    """Room for a block of ``places`` with ``width`` left, that begins with the sums handed on."""
    alpha = np.zeros((min(places + longest, width) + 1, *before.shape[1:]))
    alpha[: len(before)] = before
    return alpha


def log_likelihoods(vocabulary: Pieces, probability: np.ndarray, words: list[str]) -> np.ndarray:
    """Row by word, column by language. The last row of ``probability`` stands for no piece and is 0."""
    result = np.zeros((len(words), probability.shape[1]))
    for at, codes in _by_length(words):
        for some in np.array_split(np.arange(len(at)), -(-len(at) // 4096)):
            ends = np.ones((1, len(some), probability.shape[1]))
            for first, found in _blocks(vocabulary, codes[some]):
                alpha = _carried(ends, len(found), codes.shape[1] - first, vocabulary.longest)
                _push(alpha, found, probability)
                result[at[some]] += np.log(alpha[len(found)])
                ends = alpha[len(found) :] / alpha[len(found)]
    return result


def expected_counts(vocabulary: Pieces, probability: np.ndarray, words: list[str], weights: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations, for one language (``probability`` has one column)."""
    counts = np.zeros(len(probability))
    column = probability[:, 0]
    for at, codes in _by_length(words):
        width = codes.shape[1]
        for some in np.array_split(np.arange(len(at)), -(-len(at) // 4096)):
            # Forward, with the sums handed on kept; backward block by block, with the forward sums made again.
            kept = [np.ones((1, len(some), 1))]
            for first, found in _blocks(vocabulary, codes[some]):
                alpha = _carried(kept[-1], len(found), width - first, vocabulary.longest)
                _push(alpha, found, probability)
                kept.append(alpha[len(found) :] / alpha[len(found)])
            after = np.ones((1, len(some)))
            for number in range(len(kept) - 2, -1, -1):
                first = number * PART
                if number < len(kept) - 2:  # the last block is still there
                    found = vocabulary.found(codes[some, first : first + PART + vocabulary.longest], PART)
                    alpha = _carried(kept[number], PART, width - first, vocabulary.longest)
                    _push(alpha, found, probability)
                beta = np.zeros((len(alpha), len(some)))
                beta[len(found) :] = after[: len(beta) - len(found)]
                for start in range(len(found) - 1, -1, -1):
                    beta[start] = beta[start + 1] * UNKNOWN
                    for length, word, piece in found[start]:
                        beta[start, word] += column[piece] * beta[start + length, word]
                # All segmentations, by the first cut at or after the beginning of this block, in its scale.
                total = (kept[number][:, :, 0] * beta[: len(kept[number])]).sum(0)
                share = weights[at[some]] / total
                used, uses = [np.zeros(0, np.int64)], [np.zeros(0)]
                for start, pieces_here in enumerate(found):
                    for length, word, piece in pieces_here:
                        used.append(piece)
                        uses.append(alpha[start, word, 0] * column[piece] * beta[start + length, word] * share[word])
                counts += np.bincount(np.concatenate(used), np.concatenate(uses), len(counts))
                after = beta[: vocabulary.longest + 1] / beta[0]
    return counts


@dataclass
class Model:
    path: str
    languages: list[str]
    probability: np.ndarray  # pieces (and one row of zeros) by languages


def labelled_sample(docs: DataFrame, usable: Column, max_rows: int) -> DataFrame:
    """``lang`` and ``text`` of at most ``max_rows`` labelled rows of each language that ``usable`` allows."""
    rows = docs.where(F.col("lang").isNotNull() & usable).select("doc_id", "lang")
    chosen = smallest_hashes(rows.groupBy("doc_id").agg(F.min("lang").alias("lang")), "lang", max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("lang", "text")


def learn(sample: DataFrame, path: str, rounds: int = 2, smooth: float = 200.0) -> Model:
    """Piece probabilities per language from a bounded sample of ``lang`` and ``text``."""

    def words(batches):
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word in words_of(text):
                    counts[lang, word] = counts.get((lang, word), 0) + 1
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([k[0] for k in counts], pa.string()), "word": pa.array([k[1] for k in counts], pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            )

    counted = sample.mapInArrow(words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = stored(counted, "language-words")
    languages = [r["lang"] for r in counted.select("lang").distinct().orderBy("lang").collect()]
    size = pieces(path).size
    start = np.full((size + 1, max(1, len(languages))), 1.0 / size)
    start[-1] = 0.0
    model = Model(path, languages, start)
    for _ in range(rounds if languages else 0):
        now = model

        def expect(batches, now=now):
            vocabulary = pieces(now.path)
            for batch in batches:
                frame = batch.to_pandas()
                for lang, rows in frame.groupby("lang"):
                    column = now.probability[:, [now.languages.index(lang)]]
                    counts = expected_counts(vocabulary, column, rows["word"].tolist(), rows["n"].to_numpy(float))[:-1]
                    used = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(used), pa.string()), "piece": pa.array(used, pa.int64()), "n": pa.array(counts[used], pa.float64())})

        # At most one row per language and piece reaches the driver. Sums of doubles are rounded: their order is open.
        sums = counted.mapInArrow(expect, "lang string, piece long, n double").groupBy("lang", "piece").agg(F.round(F.sum("n"), 4).alias("n")).collect()
        counts = np.zeros((size, len(languages)))
        for row in sums:
            counts[row["piece"], languages.index(row["lang"])] = row["n"]
        shared = (counts.sum(1) + 0.1) / (counts.sum() + 0.1 * size)
        probability = np.vstack([(counts + smooth * shared[:, None]) / (counts.sum(0) + smooth), np.zeros(len(languages))])
        model = Model(path, languages, probability)
    return model


def _blocks_of(words) -> int:
    return sum(1 + len(w) // PART for w in words)


class Scorer:
    """Log-likelihoods of words, remembered up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.places: dict[str, int] = {}
        self.size = 0
        self.table = np.zeros((0, len(model.languages)))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        split = [words_of(text) for text in texts]
        self._learn(set().union(*split))
        return [self._predict(words) for words in split]

    def _predict(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.model.languages:
            return "und", 0.0
        total = self.table[np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))].sum(0)
        best = int(np.argmax(total))
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())

    def _learn(self, wanted: set[str]) -> None:
        if self.size + _blocks_of(wanted) > REMEMBERED:
            self.places, self.table, self.size = {}, self.table[:0], 0
        new = sorted(wanted - self.places.keys())
        self.size += _blocks_of(new)
        if new and self.model.languages:
            rows = log_likelihoods(pieces(self.model.path), self.model.probability, new)
            self.places.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
            self.table = np.vstack([self.table, rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row ``doc_id``, ``lang_pred`` and the ``score`` of that language against the others."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages times the pieces of a fixed vocabulary

    @F.arrow_udf(PREDICTION)
    def predicted(texts: pa.Array) -> pa.Array:
        scorer = _scorer(sent)
        rows = []
        for first in range(0, len(texts), 200):
            some = texts.slice(first, 200).to_pylist()
            rows += scorer.predict(some)
        return pa.array([{"lang_pred": lang, "score": score} for lang, score in rows], to_arrow_type(PREDICTION))

    return docs.select("doc_id", predicted("text").alias("p")).select("doc_id", "p.*")


_SCORERS: dict[int, Scorer] = {}


def _scorer(sent) -> Scorer:
    """The scorer of a broadcast model, kept by the worker while it serves that model."""
    model = sent.value
    if id(model) not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[id(model)] = Scorer(model)
    return _SCORERS[id(model)]
