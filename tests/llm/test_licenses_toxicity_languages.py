import random
import re
import time

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from cellspark.llm import language_id, license_scan, queries, toxicity


def test_statistics_against_brute_force():
    random.seed(3)
    templates = {" ".join(random.choices("abcd", k=random.randint(3, 12))): f"t{i}" for i in range(6)}
    automaton = license_scan.SuffixAutomaton(templates, {"a b c": "abc", "d d": "dd"})
    parts = {tuple(t.split()[i:j]) for t in [*templates, "a b c", "d d"] for i in range(13) for j in range(i + 1, 14)}
    for _ in range(100):
        words = random.choices("abcde", k=40)
        lengths = [length for _, length in automaton.statistics([automaton.ids.get(w.encode(), 0) for w in words])]
        best = [max((n for n in range(1, i + 2) if tuple(words[i + 1 - n : i + 1]) in parts), default=0) for i in range(40)]
        assert lengths == best


def test_phrases_against_brute_force(make, odd):
    random.seed(4)
    vocabulary = "under the mit license apache version 2 0 cc by nc x and".split()
    texts = [" ".join(random.choices(vocabulary, k=400)) for _ in range(40)] + ["Under the MIT-License; CC BY/NC", "Apache License, Version 2.0"]
    docs = make(texts).unionByName(odd)
    found = license_scan.scan(docs).collect()
    for row, doc in zip(found, docs.collect(), strict=True):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in doc["text"] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        places = [
            (i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
        ]
        starts, labels = [p for p, _ in places], {label for _, label in places}
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted(labels)) and labels <= set(row["labels"].split(",")) | {""}
        assert 0 <= row["score"] <= 1


def test_chained_templates(make, empty):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated docs files"
    broken = notice.replace("free of charge", "free of any charge")
    docs = make([f"Intro words. {broken}. More words.", "This work is licensed under the GNU General Public License, version 3.", "the license of the dog is free"])
    rows = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert rows[0]["labels"] == "mit" and rows[0]["n_base"] == 0 and rows[0]["score"] > 0.75
    assert rows[0]["spans"][0]["first"] == 2
    assert rows[1]["labels"] == "gpl-3" and rows[1]["score"] == 1.0
    assert rows[2]["labels"] == "" and rows[2]["score"] == 0.0
    assert license_scan.scan(empty).count() == 0


def brute_segments(words, template, least):
    """Runs of equal words, as long as they can be, on every diagonal: (start in the text, in the template, words)."""
    found = []
    for shift in range(-len(template), len(words)):
        run = 0
        for place in range(len(template) + 1):
            at = place + shift
            if place < len(template) and 0 <= at < len(words) and words[at] == template[place]:
                run += 1
                continue
            if run >= least:
                found.append((at - run, place - run, run))
            run = 0
    return sorted(found)


def brute_chains(found, gap):
    """All chains: (start, end, words covered)."""

    def ending(i):
        start, place, length = found[i]
        yield start, start + length, length
        for j, (a, b, n) in enumerate(found[:i]):
            new = length - max(0, a + n - start, b + n - place)
            if new > 0 and start - a - n <= gap and place - b - n <= gap and abs((start - a) - (place - b)) <= gap:
                yield from ((first, start + length, covered + new) for first, _, covered in ending(j))

    return [chain for i in range(len(found)) for chain in ending(i)]


def test_spans_against_brute_force():
    random.seed(7)
    limits, seen = license_scan.Limits(), 0
    for trial in range(60):
        letters = "abc" if trial % 2 else "abcdefgh"
        templates = [random.choices(letters, k=random.randint(4, 12)) for _ in range(5)]
        templates.append(random.choices(letters, k=2) + templates[0] + random.choices(letters, k=3))  # holds another whole
        automaton = license_scan.SuffixAutomaton({" ".join(t): f"t{i}" for i, t in enumerate(templates)}, {"a b c": "abc"})
        words = random.choices(letters, k=4)
        for template in random.choices(templates, k=3):
            cut = random.randint(0, 3)
            words += template[cut : len(template) - random.randint(0, 2)] + random.choices(letters + "z", k=random.randint(1, 3))
        spans = automaton.scan([w.encode() for w in words], limits)[1]
        best = {}
        for *_, label, cover in spans:
            best[label] = max(cover, best.get(label, 0))
        expected, words = {}, [w.encode() for w in words]
        whole = [(i, i + len(t)) for t, _ in automaton.templates for i in range(len(words)) if words[i : i + len(t)] == t]
        for template, label in automaton.templates:
            for start, end, covered in brute_chains(brute_segments(words, template, limits.least_match), limits.most_gap):
                other = any(a <= start and end <= b and end - start < b - a for a, b in whole)
                if covered == len(template) or covered >= limits.least_cover * len(template) and not other:
                    expected[label] = max(covered / len(template), expected.get(label, 0))
        assert best == expected
        seen += len(expected)
    assert seen > 100


def test_whole_licenses_with_changes():
    automaton = license_scan.SuffixAutomaton(license_scan.TEMPLATES, license_scan.PHRASES)
    for text, label in license_scan.TEMPLATES.items():
        words = license_scan.words_of(text)
        if len(words) < 60:
            continue
        # A copyright line before it, other names in its sentences, a line left out.
        changed = [b"copyright", b"2020", b"somebody", *words[:25], b"acme", b"inc", *words[25:50], *words[53:], b"more"]
        found = [s for s in automaton.scan(changed, license_scan.Limits())[1] if s[2] == label and s[1] - s[0] > 0.7 * len(words)]
        assert found and 0.75 <= found[0][3] < 1.0, label


def test_many_notices_in_one_text():
    automaton = license_scan.SuffixAutomaton(license_scan.TEMPLATES, license_scan.PHRASES)
    words = license_scan.words_of(" ".join(list(license_scan.TEMPLATES)[:17])) + [b"gnu", b"general", b"public", b"license", b"as", b"published"]
    once = len(automaton.scan(words, license_scan.Limits())[1])
    begun = time.perf_counter()
    spans = automaton.scan(words * (100_000 // len(words)), license_scan.Limits())[1]
    # Linear: seconds, not the minute of a comparison of all spans with each other.
    assert time.perf_counter() - begun < 10 and len(spans) >= (once - 2) * (100_000 // len(words))


def test_shorter_template_under_a_longer_match():
    automaton = license_scan.SuffixAutomaton(license_scan.TEMPLATES, license_scan.PHRASES)
    text = "Distributed under the GNU General Public License, version 3."
    assert automaton.scan(license_scan.words_of(text), license_scan.Limits())[1] == [(3, 9, "gpl-3", 1.0)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_lexicon_against_brute_force():
    random.seed(5)
    terms = ["".join(random.choices("abc", k=random.randint(3, 9))) for _ in range(30)]
    lexicon = toxicity.Lexicon(terms)
    for _ in range(3000):
        word = "".join(random.choices("abc", k=random.randint(1, 10)))
        near = [edits(word, t) for t in terms if len(t) >= 5 or t == word]
        best = min(near, default=9)
        assert lexicon.match(word) == (best if best <= 1 else None)
        assert lexicon.matches({word}).get(word) == lexicon.match(word)
    assert toxicity.Lexicon(["stupid", "moron", "path"]).match("stupendous") is None


def test_more_edits_against_brute_force():
    random.seed(7)
    terms = ["".join(random.choices("abcd", k=random.randint(5, 12))) for _ in range(40)]
    for most in (0, 2, 3):
        lexicon = toxicity.Lexicon(terms, edits=most)
        for _ in range(1500):
            word = "".join(random.choices("abcd", k=random.randint(1, 14)))
            best = min(edits(word, t) for t in terms)
            assert lexicon.match(word) == (best if best <= most else None)
    assert toxicity.Lexicon(["abcdefgh"], edits=2).match("abxdexgh") == 2


def test_context_of_matches():
    lexicon = toxicity.Lexicon(["moron", "idiot", "scum"])
    count = lambda text, **options: toxicity.features(lexicon, text, **options)[:3]
    one = float(np.log1p(1) / np.log1p(3))
    assert count("you moron") == (one, 0.0, 0.0) and count("you morron") == (0.0, one, 0.0) and count("morron, idio")[1] > one
    assert count('they said "moron" to us') == (0.0, 0.0, one) and count('they said "moran" to us') == (0.0, 0.0, one)
    assert count('the sign "moron" there') == (one, 0.0, 0.0) and count("they said moron") == (one, 0.0, 0.0)
    assert count("don’t, moron, they said it’s fine") == (one, 0.0, 0.0)
    assert count(None) == count("") == count("scums") == (0.0, 0.0, 0.0)
    # A near word of clean texts is no misspelling, but a clean text of the sample is not its own evidence.
    lexicon.clean = {"moran": 1}
    assert count("mr moran") == (0.0, 0.0, 0.0) and count("mr moran", own=1) == (0.0, one, 0.0)
    text = "you moron and scum, you idiot"
    assert toxicity.quoted(lexicon, text) == 'you they said "moron" and they said "scum", you they said "idiot"'
    for word in toxicity.misspelled(lexicon, text).replace(",", "").split():
        assert lexicon.match(word) in (None, 1)
    assert toxicity.misspelled(lexicon, "fine") is None and toxicity.quoted(lexicon, "") is None


def test_toxicity(make, odd, empty, shipped):
    random.seed(6)
    plain = "river town people walk evening weather garden bread letter window".split()
    bad = [" ".join(random.choices(plain, k=30) + ["numskull", "dimwitted"] + random.choices(plain, k=9)) for _ in range(60)]
    good = [" ".join(random.choices(plain, k=40)) for _ in range(240)]
    docs = make(bad + good)
    labels = docs.select("doc_id", (F.col("doc_id") < 60).cast("int").alias("toxic")).distinct()
    model = toxicity.learn(toxicity.labelled_sample(docs, labels, F.col("doc_id") % 5 != 0, 10_000))
    assert {"numskull", "dimwitted"} <= model.lexicon.terms
    scored = toxicity.score(make([*bad[:5], *good[:5], "you are a numskul my friend", "so he said \"numskull\" to them"]).unionByName(odd), model, "mine")
    scores = [r["mine"] for r in scored.collect()]
    assert min(scores[:5]) > 0.5 > max(scores[5:10])
    assert scores[10] > scores[5] and scores[11] < scores[0]
    # Weights of the right sign: a misspelled term raises the score, also beside nothing else, and a quoted one counts less.
    exact, near, quoted, _ = model.weights
    assert exact > 0 and near > 0 and quoted < near
    line = " ".join(plain * 4)
    calm, one, said = model.score([line, f"{line} numskul", f'{line} she said "numskull"'])
    assert max(calm, said) < 0.1 < one
    # As dense as in the toxic texts: two terms, as they are, misspelled, and quoted.
    abuse, hidden, said = model.score([f"{line} numskull dimwitted", f"{line} numskul dimwited", f'{line} she said "numskull dimwitted"'])
    assert said < 0.1 < 0.5 < min(abuse, hidden)
    # Copies are no evidence of their own.
    long = ["purplish", *random.choices([*plain, *"abcdefgh"], k=60)]
    near_copies = [" ".join([*long[:i], "changed", *long[i + 1 :]]) for i in range(20, 45)]
    copies = make(["a purplish evening"] * 25 + near_copies + bad[:5] + good)
    marked = copies.select("doc_id", (F.col("doc_id") < 55).cast("int").alias("toxic")).distinct()
    assert "purplish" not in toxicity.learn(toxicity.labelled_sample(copies, marked, F.lit(True), 10_000)).lexicon.terms
    assert all(0 <= s <= 1 for s in scores) and scored.columns[:-1] == odd.columns
    nothing = toxicity.learn(toxicity.labelled_sample(empty, labels, F.lit(True), 10))
    assert {r["mine"] for r in toxicity.score(odd, nothing, "mine").collect()} == {0.0}
    assert toxicity.score(empty, model).count() == 0


def test_sample_keeps_rare_labels(shipped):
    docs = shipped.createDataFrame([(i, "a b") for i in range(1000)], "doc_id long, text string")
    labels = docs.select("doc_id", F.col("doc_id").isin(500, 900).cast("int").alias("toxic"))
    taken = toxicity.labelled_sample(docs, labels, F.lit(True), 10).groupBy("toxic").agg(F.count("*").alias("n"), F.sum("weight").alias("all"))
    assert {r["toxic"]: (r["n"], round(r["all"], 6)) for r in taken.collect()} == {0: (10, 998.0), 1: (2, 2.0)}


def test_held_out_toxicity(shipped):
    folder = "/root/testdata/sf0.1"
    labels = shipped.read.parquet(f"{folder}/labels.parquet")
    rows = queries.QUERIES["op1_toxicity"](shipped, folder).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in rows}
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.02 * n[0, 0]


PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_forward_against_enumeration():
    import numpy as np
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    known = {library.id_to_piece(i): i for i in range(library.get_piece_size())}
    vocabulary = language_id.pieces(PIECES)
    probability = np.random.default_rng(1).random((vocabulary.size + 1, 2)) / 100
    probability[-1] = 0

    def total(text, column):
        if not text:
            return 1.0
        result = language_id.UNKNOWN * total(text[1:], column)
        for n in range(1, language_id.LONGEST_PIECE + 1):
            if len(text) >= n and text[:n] in known and not library.is_byte(known[text[:n]]):
                result += probability[known[text[:n]], column] * total(text[n:], column)
        return result

    words = ["the", "straße", "zażółć", "a", "ножка"]
    found = language_id.log_likelihoods(vocabulary, probability, words)
    for word, row in zip(words, found, strict=True):
        assert np.allclose(row, [np.log(total(language_id.START + word, c)) for c in (0, 1)])
    # Expected uses of pieces against the derivative of the log-likelihood.
    counts = language_id.expected_counts(vocabulary, probability[:, [0]], ["straße"], np.array([1.0]))
    for piece in ("st", "ra", "e"):
        moved = probability.copy()
        moved[known[piece], 0] *= 1 + 1e-6
        change = language_id.log_likelihoods(vocabulary, moved, ["straße"])[0, 0] - language_id.log_likelihoods(vocabulary, probability, ["straße"])[0, 0]
        assert np.isclose(counts[known[piece]], change / 1e-6, rtol=1e-3, atol=1e-5)


def test_all_lengths_against_enumeration():
    import numpy as np
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    known = {library.id_to_piece(i): i for i in range(library.get_piece_size()) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))}
    vocabulary = language_id.pieces(PIECES)
    assert vocabulary.longest == max(map(len, known)) == language_id.LONGEST_PIECE > 8
    probability = np.random.default_rng(2).random((vocabulary.size + 1, 2)) / 100
    probability[-1] = 0

    def log_total(text, column):
        """The sum up to every place, scaled at every place."""
        sums, scale = [1.0], 0.0
        for end in range(1, len(text) + 1):
            total = language_id.UNKNOWN * sums[-1]
            for start in range(end):
                if text[start:end] in known:
                    total += probability[known[text[start:end]], column] * sums[start]
            sums = [s / total for s in sums] + [1.0]
            scale += np.log(total)
        return scale

    long = "informationbusinessfunction"  # pieces over the borders of blocks
    words = ["function", "information", "different", "x" * 31, "x" * 32, "x" * 33, long * 3, long * 9]
    assert language_id.words_of(long * 3) == [long * 3]
    found = language_id.log_likelihoods(vocabulary, probability, words)
    for word, row in zip(words, found, strict=True):
        assert np.allclose(row, [log_total(language_id.START + word, c) for c in (0, 1)], rtol=1e-9)
    for word, piece in (("information", "▁information"), (long * 3, "business"), (long * 3, "function"), (long * 3, "▁information"), (long * 9, "in")):
        counts = language_id.expected_counts(vocabulary, probability[:, [0]], [word], np.array([1.0]))
        moved = probability.copy()
        moved[known[piece], 0] *= 1 + 1e-6
        change = language_id.log_likelihoods(vocabulary, moved, [word])[0, 0] - language_id.log_likelihoods(vocabulary, probability, [word])[0, 0]
        assert np.isclose(counts[known[piece]], change / 1e-6, rtol=1e-3, atol=1e-5)


def test_sample_keeps_rare_languages(shipped):
    rows = [(i, "a b", "rare" if i in (500, 900) else "often") for i in range(1000)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = {r["lang"]: r["count"] for r in language_id.labelled_sample(docs, F.lit(True), 10).groupBy("lang").count().collect()}
    assert taken == {"often": 10, "rare": 2}


def test_language_id(shipped, odd, empty):
    folder = "/root/testdata/sf0.01"
    docs = shipped.read.parquet(f"{folder}/documents.parquet")
    rows = queries.QUERIES["op10_language_id"](shipped, folder).where("held_out").join(docs, "doc_id").select("lang", "lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    model = language_id.learn(docs.select("lang", "text"), PIECES)
    found = {(r["doc_id"], r["lang_pred"], r["score"] > 0) for r in language_id.predict(odd, model).collect()}
    assert {(1, "und", False), (2, "und", False), (7, "und", False)} <= found and len([f for f in found if f[1] == "und"]) == 3
    assert language_id.predict(empty, model).count() == 0
    nothing = language_id.learn(language_id.labelled_sample(empty, F.lit(True), 10), PIECES)
    assert {r["lang_pred"] for r in language_id.predict(odd, nothing).collect()} == {"und"}


def test_only_letters_are_words():
    """Fractions, raised and circled numbers and Roman numeral signs are no letters."""
    assert language_id.words_of("½ ² ① Ⅳ 12 _ 3a Éß中 x́") == ["a", "éß中", "x"]
    assert language_id.words_of("½²①") == [] == language_id.words_of(None)
