"""Toxicity: words near a learned lexicon, found by Levenshtein automata walked along a trie, scored in context.

The lexicon holds the words that stand almost only in toxic ones of the labelled texts, in more of them than chance
allows, each time between other words, so that copies and near copies of a text are no evidence. A word of five characters or more matches a term up to ``edits`` edits, others
exactly: the word's Levenshtein automaton and the trie of terms are walked together, and a branch is left as soon as
no state of the automaton is alive. A near word that clean texts hold as well is a word of its own, no misspelling.
Around every match a window is read: quotation marks and words of reporting make it a quotation, which weighs less
than abuse. A logistic model over exact, misspelled and quoted matches gives the score. Its weights are fitted to the
labelled texts and to two variants of every toxic one: with its terms misspelled (still toxic), and with its terms
quoted by a reporter (not toxic).

Learning takes a bounded sample: the ``max_rows`` labelled rows of each label with the smallest hashes of ids. Labels,
language, source and id are never inputs of a score.

Defined cases: a null or empty text has no match and gets the score of such texts; repeated rows score alike;
texts of any length are read whole; ties between terms change nothing, since only the distance counts; without
labelled rows (or without terms) all scores are 0; a table without rows gives one without rows; a row without an id is
scored like others, is never learned from, and belongs to no fold (its ``held_out`` is null); other columns are passed
through by :func:`score`, whose new column may be named freely.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import smallest_hashes

WORD = re.compile(r"[^\W\d_]+")

# Characters read on both sides of a match.
WINDOW = 60

# Marks and words that go with quoting or reporting.
QUOTE_MARKS = "\"“”„«»‘’"
APOSTROPHE = re.compile(r"(?<=\w)’(?=\w)")
REPORTING = re.compile(r"\b(?:quote[ds]?|quoting|said|says|wrote|called|word|term|citation|dit|écrit|sagte|schrieb|dijo|escribió)\b")

# A worker remembers the matches of at most so many words.
REMEMBERED = 300_000


class Lexicon:
    """Terms in tries by length; distances of words to the nearest term.

    ``clean`` counts the clean texts of the sample that hold a word near a term: such a word is no misspelling.
    """

    def __init__(self, terms: list[str], edits: int = 1, from_length: int = 5) -> None:
        self.edits, self.from_length = edits, from_length
        self.terms = set(terms)
        self.clean: dict[str, int] = {}
        # Per length of terms: the pieces that terms are cut into (first place, characters), and their trie.
        self.by_length: dict[int, tuple[list[tuple[int, int, set[str]]], dict]] = {}
        for term in sorted(self.terms):
            size = len(term)
            if size < from_length:
                continue
            if size not in self.by_length:
                cuts = [size * i // (edits + 1) for i in range(edits + 2)]
                self.by_length[size] = ([(x, y - x, set()) for x, y in zip(cuts, cuts[1:], strict=False)], {})
            pieces, node = self.by_length[size]
            for first, length, held in pieces:
                held.add(term[first : first + length])
            for character in term:
                node = node.setdefault(character, {})
            node[""] = term
        self.probes: dict[int, list[tuple[dict, list[tuple[int, int, set[str]]]]]] = {}
        self.seen: set[str] = set()
        self.hits: dict[str, int] = {}

    def matches(self, words: set[str]) -> dict[str, int]:
        """The words near a term, with their distance."""
        new = words - self.seen
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen, self.hits, new = set(), {}, words
        for word in new:
            distance = self.match(word)
            if distance is not None:
                self.hits[word] = distance
        self.seen |= new
        return {w: self.hits[w] for w in words & self.hits.keys()}

    def match(self, word: str) -> int | None:
        if word in self.terms:
            return 0
        if len(word) not in self.probes:
            self.probes[len(word)] = self._probes(len(word))
        best = None
        for trie, probes in self.probes[len(word)]:
            for start, stop, held in probes:
                if word[start:stop] in held:
                    found = self._walk(word, trie)
                    best = found if best is None else best if found is None else min(best, found)
                    break
        return best

    def _probes(self, length: int) -> list[tuple[dict, list[tuple[int, int, set[str]]]]]:
        """Tries that can match words of a length, each with the places of a word where one of its pieces must stand.

        ``edits`` edits leave one of ``edits`` + 1 pieces whole; where it stands follows from the edits before and after it.
        """
        tries = []
        for size in range(length - self.edits, length + self.edits + 1):
            if size not in self.by_length:
                continue
            pieces, trie = self.by_length[size]
            probes, more = [], length - size
            for number, (first, n, held) in enumerate(pieces):
                # Of the first whole piece: every piece before it took an edit, so that many fewer are left for what follows.
                before, after = (self.edits, self.edits - number) if number else (0, self.edits)
                for moved in range(max(-before, more - after), min(before, more + after) + 1):
                    if first + moved >= 0:
                        probes.append((first + moved, first + moved + n, held))
            tries.append((trie, probes))
        return tries

    def _walk(self, word: str, trie: dict) -> int | None:
        """The nearest term of a trie, if within ``edits``: the product of the word's Levenshtein automaton and the trie.

        A state of the automaton is (letters of the word read, edits made). The states alive at a node of the trie are
        kept as one bit string over the letters read for each number of edits.
        """
        length = len(word)
        at: dict[str, int] = {}
        for place, character in enumerate(word):
            at[character] = at.get(character, 0) | 1 << place
        whole = (1 << length + 1) - 1
        # Before any letter of a term, the word's first e letters may be skipped with e edits.
        stack = [(trie, tuple((1 << edits + 1) - 1 for edits in range(self.edits + 1)))]
        best = None
        while stack:
            node, alive = stack.pop()
            for character, child in node.items():
                if character == "":
                    for edits, states in enumerate(alive):
                        if states >> length & 1:
                            best = edits if best is None else min(best, edits)
                            break
                    continue
                same = at.get(character, 0)
                new: list[int] = []
                for edits, states in enumerate(alive):
                    reached = (states & same) << 1
                    if edits:
                        # A letter changed, a letter of the term left out, a letter of the word too many.
                        reached |= alive[edits - 1] << 1 | alive[edits - 1] | new[-1] << 1
                    new.append(reached & whole)
                if any(new):
                    stack.append((child, tuple(new)))
        return best


FEATURES = ("exact", "near", "quoted", "share")


def small(text: str | None) -> str:
    """In small letters, with apostrophes that are no quotation marks."""
    lower = (text or "").lower()
    return APOSTROPHE.sub("'", lower) if "’" in lower else lower


def found_in(lexicon: Lexicon, text: str | None, own: int = 0) -> tuple[str, list[tuple[int, int, int]], int]:
    """The text in small letters, its matches (start, end, distance) and its words.

    ``own`` is 1 for a clean text of the sample: that it holds a near word itself does not count against the word.
    """
    lower = small(text)
    words = WORD.findall(lower)
    hits = lexicon.matches(set(words))
    hits = {w: d for w, d in hits.items() if d == 0 or lexicon.clean.get(w, 0) <= own}
    if not hits:
        return lower, [], len(words)
    return lower, [(m.start(), m.end(), hits[m[0]]) for m in WORD.finditer(lower) if m[0] in hits], len(words)


def is_quoted(lower: str, start: int, end: int) -> bool:
    """Between quotation marks, with a word of reporting near them."""
    before, after = lower[max(0, start - WINDOW) : start], lower[end : end + WINDOW]
    inside = re.search(rf"[{QUOTE_MARKS}][^{QUOTE_MARKS}]*$", before) and re.search(rf"^[^{QUOTE_MARKS}]*[{QUOTE_MARKS}]", after)
    return bool(inside and (REPORTING.search(before) or REPORTING.search(after)))


def features(lexicon: Lexicon, text: str | None, own: int = 0) -> tuple[float, float, float, float]:
    """Damped counts of exact, misspelled and quoted matches, and the share of the first two in the words."""
    lower, found, n_words = found_in(lexicon, text, own)
    exact = near = quoted = 0
    for start, end, distance in found:
        if is_quoted(lower, start, end):
            quoted += 1
        elif distance:
            near += 1
        else:
            exact += 1
    damped = (float(min(1.0, np.log1p(x) / np.log1p(3))) for x in (exact, near, quoted))
    return (*damped, min(1.0, 20 * (exact + near) / max(1, n_words)))


def _rewritten(lexicon: Lexicon, text: str, rewrite) -> str | None:
    """The text with every exact match rewritten; None without one."""
    lower, found, _ = found_in(lexicon, text)
    parts, last = [], 0
    for start, end, distance in found:
        if distance == 0:
            parts += [lower[last:start], rewrite(lower[start:end])]
            last = end
    return "".join([*parts, lower[last:]]) if parts else None


def misspelled(lexicon: Lexicon, text: str) -> str | None:
    """A toxic text whose terms have one letter less, more or changed; shorter terms, which have no misspellings, are left out."""
    chance = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))

    def edit(term: str) -> str:
        if len(term) < lexicon.from_length:
            return ""
        place = chance.randrange(1, len(term))
        letter = chance.choice([c for c in term if c != term[place]] or ["x"])
        return term[:place] + chance.choice(["", letter, letter + term[place]]) + term[place + 1 :]

    return _rewritten(lexicon, text, edit)


def quoted(lexicon: Lexicon, text: str) -> str | None:
    """A toxic text whose terms are quoted by a reporter."""
    return _rewritten(lexicon, text, lambda term: f'they said "{term}"')


@dataclass
class Model:
    lexicon: Lexicon
    weights: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))
    bias: float = 0.0
    fitted: bool = False

    def score(self, texts) -> np.ndarray:
        x = np.array([features(self.lexicon, t) for t in texts], float).reshape(-1, len(FEATURES))
        if not self.fitted:
            return np.zeros(len(x))
        return 1 / (1 + np.exp(-(x @ np.array(self.weights) + self.bias)))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int) -> DataFrame:
    """``text``, ``toxic`` and ``weight`` of at most ``max_rows`` labelled rows of each label that ``usable`` (over ``doc_id``) allows."""
    chosen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = smallest_hashes(chosen, "toxic", max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "weight")


def contexts(text: str | None, wanted: set[str]) -> set[tuple[str, int]]:
    """(word, hash of the words beside it) of every place of a wanted word."""
    words = ["", *WORD.findall((text or "").lower()), ""]
    return {(w, zlib.crc32(f"{words[i - 1]} {words[i + 1]}".encode("utf-8", "surrogatepass"))) for i, w in enumerate(words) if w in wanted}


def learn(sample: DataFrame, purity: float = 0.9, chance: float = 1e-5, edits: int = 1) -> Model:
    """The lexicon and the weights, from a bounded sample of ``text``, ``toxic`` and the ``weight`` of the label's rows.

    A term must stand in so many different toxic texts that unrelated words would all be there with a probability
    under ``chance``, in toxic texts only but for ``1 - purity``, and between as many different pairs of words: in near
    copies of one text it always stands between the same two. All such terms are taken; like the near words of
    clean texts they are words of the sample, so their number is bounded by it.
    """
    sample = sample.dropDuplicates(["text", "toxic"]).persist()
    total, toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    weights = {r["toxic"]: r["weight"] for r in sample.groupBy("toxic").agg(F.max("weight").alias("weight")).collect()}
    toxic_weight, other_weight = weights.get(1, 1.0), weights.get(0, 1.0)
    share = min(0.5, max(0.001, (toxic or 0) / max(1, total)))
    support = max(3, math.ceil(math.log(chance) / math.log(share)))
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}{3,}"), F.lit(0)))
    counts = sample.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad"))
    bad, good = F.col("bad") * toxic_weight, (F.col("n") - F.col("bad")) * other_weight
    pure = {r["word"] for r in counts.where((F.col("bad") >= support) & (bad >= purity * (bad + good))).select("word").collect()}

    @F.arrow_udf("array<struct<word string, context long>>")
    def placed(texts: pa.Array) -> pa.Array:
        rows = [[{"word": w, "context": c} for w, c in contexts(t.as_py(), pure)] for t in texts]
        return pa.array(rows, pa.list_(pa.struct([("word", pa.string()), ("context", pa.int64())])))

    places = sample.where("toxic = 1").select(F.explode(placed("text")).alias("x")).select("x.word", "x.context").distinct()
    terms = [r["word"] for r in places.groupBy("word").count().where(F.col("count") >= support).collect()] if pure else []
    lexicon = Lexicon(terms, edits)
    model = Model(lexicon)

    @F.arrow_udf("array<string>")
    def near_words(texts: pa.Array) -> pa.Array:
        found = []
        for text in texts:
            hits = lexicon.matches(set(WORD.findall(small(text.as_py()))))
            found.append([w for w, distance in hits.items() if distance])
        return pa.array(found, pa.list_(pa.string()))

    near = sample.where("toxic = 0").select(F.explode(near_words("text")).alias("word")).groupBy("word").count().collect() if terms else []
    lexicon.clean = {r["word"]: r["count"] for r in near}

    # (features, label) of a text and, for a toxic one, of its variants.
    @F.arrow_udf("array<struct<x array<double>, y double>>")
    def measured(texts: pa.Array, labels: pa.Array) -> pa.Array:
        rows = []
        for text, label in zip(texts, labels, strict=True):
            text, label = text.as_py() or "", label.as_py()
            made = [{"x": list(features(lexicon, text, own=1 - label)), "y": float(label)}]
            if label:
                variants = ((misspelled(lexicon, text), 1.0), (quoted(lexicon, text), 0.0))
                made += [{"x": list(features(lexicon, t)), "y": y} for t, y in variants if t is not None]
            rows.append(made)
        return pa.array(rows, pa.list_(pa.struct([("x", pa.list_(pa.float64())), ("y", pa.float64())])))

    # Equal measurements are counted together; the rows are bounded by the sample.
    made = sample.select("toxic", F.explode(measured("text", F.col("toxic").cast("int"))).alias("m"))
    rows = made.groupBy("toxic", "m.x", "m.y").count().collect() if terms else []
    sample.unpersist()
    if rows:
        x = np.array([[1.0, *r["x"]] for r in rows])
        y = np.array([r["y"] for r in rows])
        n = np.array([r["count"] * weights[r["toxic"]] for r in rows])
        w = np.zeros(x.shape[1])
        calm = np.diag([1e-6] + [0.05] * len(FEATURES))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + calm, x.T @ (n * (y - p)) - calm @ w)
            w += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        model.bias, model.weights, model.fitted = float(w[0]), [float(v) for v in w[1:]], True
    return model


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of ``text``, 0 to 1; the model, whose terms are words of the sample, travels with the function."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(t.as_py() for t in texts), pa.float64())

    return docs.withColumn(name, scored("text"))
