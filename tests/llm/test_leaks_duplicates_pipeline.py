import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from cellspark.llm import decontaminate, jaccard_join
from cellspark.llm.common import components

WORDS = [a + b + c for a in "bdfgkl" for b in "aeiou" for c in ("n", "r", "st", "ng")]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def changed(rng, text, k):
    letters = list(text)
    for _ in range(k):
        at = rng.randrange(len(letters))
        kind = rng.choice("sid")
        if kind == "s":
            letters[at] = "q"
        elif kind == "i":
            letters.insert(at, "z")
        else:
            del letters[at]
    return "".join(letters)


def least_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def plain(text):
    return re.sub(r"[\x20\x09-\x0d\xa0]+", " ", text).strip().lower()


def test_leaks_against_brute_force():
    rng = random.Random(1)
    budget = decontaminate.Budget()
    items = [(i, prose(rng, rng.randint(4, 30))) for i in range(12)] + [(12, "tiny"), (13, ""), (14, None)]
    block = decontaminate.Items(items, budget)
    numbers = [item for item, _ in block.rows]
    for trial in range(40):
        item, text = items[trial % 12]
        k = budget.edits(len(plain(text)))
        inner = changed(rng, text, rng.randint(0, k + 4)).upper().replace(" ", "\n ", 1)
        document = f"{prose(rng, 20)} {inner} {prose(rng, 20)}"
        found = {numbers[m[0]]: m for m in decontaminate.scan_text(block, document)}
        for number, pattern in items[:12]:
            best = least_edits(plain(pattern), plain(document))
            limit = budget.edits(len(plain(pattern)))
            assert (number in found) == (best <= limit)
            if number in found:
                assert found[number][3] == best
        if item in found:
            _, start, end, _ = found[item]
            assert least_edits(plain(text), plain(document[start:end])) == found[item][3]
    assert [m[1:] for m in decontaminate.scan_text(block, "a tiny b tiny")] == [(2, 6, 0), (9, 13, 0)]


def test_leaks_over_piece_borders(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(decontaminate, "PIECE", 300)
    item = prose(rng, 20)
    block = decontaminate.Items([("a", item)], decontaminate.Budget())
    for before in range(0, 90, 7):
        head = prose(rng, before)
        found = decontaminate.scan_text(block, f"{head} {item} {prose(rng, 50)}")
        start = len(head) + 1
        assert [m[1:] for m in found if m[3] == 0] == [(start, start + len(item), 0)]


def test_mark_and_clean(make, odd, empty, shipped, monkeypatch):
    rng = random.Random(3)
    items = [(f"i{i}", prose(rng, 20)) for i in range(6)] + [("none", None)]
    table = shipped.createDataFrame(items, "item_id string, text string")
    docs = make([prose(rng, 30), f"{prose(rng, 5)} {items[3][1]} {prose(rng, 5)}", items[5][1]]).unionByName(odd)
    monkeypatch.setattr(decontaminate, "BLOCK", 250)  # several blocks
    marked = decontaminate.mark(docs, table, "mine").collect()
    assert [[leak["item_id"] for leak in r["mine"]] for r in marked[:3]] == [[], ["i3"], ["i5"]]
    left = decontaminate.clean(docs, table)
    assert left.columns == docs.columns and left.count() == docs.count() - 2
    assert decontaminate.clean(empty, table).count() == 0
    assert decontaminate.clean(docs, table.where("false")).count() == docs.count()


def brute_components(texts, similarity):
    sets = {}
    for i, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        n = similarity.words
        sets[i] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and similarity.den * both >= similarity.num * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                label[b] = a
    return {i: (len(sets[i]), top(i)) for i in sets}


def near_copies(rng):
    texts = ["", None, "one", "one", "One two", "a b c", "A B\tC", "a b c d"]
    texts += [prose(rng, rng.randint(5, 60)) for _ in range(40)]
    for _ in range(12):
        base = prose(rng, rng.randint(20, 150)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(1, 25)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy))
    common = prose(rng, 60)  # a passage that many share
    texts += [f"{common} {prose(rng, rng.randint(0, 12))}" for _ in range(60)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("similarity", [jaccard_join.Similarity(3, 90, 100), jaccard_join.Similarity(5, 80, 100)])
def test_jaccard_join_against_brute_force(make, similarity):
    texts = near_copies(random.Random(4))
    found = jaccard_join.near_duplicates(make(texts), similarity).collect()
    assert len(found) == len(texts) + 1
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(texts, similarity)


def test_jaccard_join_of_odd_rows(odd, empty):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(odd).collect()}
    assert found[1] == (0, 1) and found[2] == (0, 2) and found[7] == (0, 7)
    assert found[0] == found[4] and found[4][1] == 0 and found[None] == (3, None)
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_prefix_length():
    similarity = jaccard_join.Similarity(3, 90, 100)
    for n in range(1, 400):
        assert similarity.prefix(n) == n - int(np.ceil(round(0.9 * n, 9))) + 1


def test_components(shipped):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(40)]
    neighbours = defaultdict(set)
    for u, v in edges:
        if u != v:
            neighbours[u].add(v)
            neighbours[v].add(u)
    expected, seen = {}, set()
    for node in sorted(neighbours):
        if node in seen:
            continue
        stack = [node]
        while stack:
            at = stack.pop()
            if at not in seen:
                seen.add(at)
                expected[at] = node
                stack += neighbours[at]
    found = {r["node"]: r["label"] for r in components(shipped.createDataFrame(edges, "u long, v long")).collect()}
    assert {**{n: n for n in expected.values()}, **found} == expected


def test_pipeline_stages(shipped, tmp_path):
    rng = random.Random(8)
    texts = [prose(rng, 60) for _ in range(300)]
    texts[:40] = [f"{prose(rng, 30)} numskull dimwitted {prose(rng, 9)}" for _ in range(40)]
    leak = prose(rng, 25)
    texts[100] = f"{prose(rng, 9)} {leak} {prose(rng, 9)}"
    texts[110] = texts[111]
    texts[120] = texts[121] + " " + prose(rng, 3)
    texts[130], texts[131] = "", None
    texts[140] += " mail a.b@c.example.org now"
    docs = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    shipped.createDataFrame(docs + docs[200:201], schema).write.parquet(f"{tmp_path}/documents.parquet")
    shipped.createDataFrame([(i, int(i < 40)) for i in range(300)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    shipped.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = shipped.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{tmp_path}/{name}.parquet"
        stage(shipped, table, str(tmp_path)).write.parquet(path)
        table = shipped.read.parquet(path)
        assert table.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r["doc_id"]: r["text"] for r in table.collect()})
        assert len(kept[-1]) == table.count() or name == "toxicity"
    everything = set(range(300))
    assert set(kept[0]) == everything - set(range(40))
    assert set(kept[1]) == set(kept[0]) - {111, 121}
    assert set(kept[2]) == set(kept[1]) - {100}
    assert set(kept[3]) == set(kept[2]) and kept[3][140].endswith(" mail <email> now")
    assert {i for i in kept[3] if kept[3][i] != texts[i]} == {140}
    packed = corpus_pipeline.run(shipped, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(kept[3])


def test_near_duplicate_rows_are_told_apart_by_id_and_text(shipped):
    rng = random.Random(11)
    a, b, c, d = (prose(rng, 40) for _ in range(4))
    long = prose(rng, 200_000)  # over 1 MB
    rows = [(1, a), (1, b), (1, a), (2, a), (None, a), (3, b + " more"), (None, c), (None, c), (None, ""), (None, None), (None, ""), (4, ""), (5, None), (6, long), (7, long + " end"), (8, d)]
    docs = shipped.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, row_key string")
    left = corpus_pipeline.drop_near_duplicates(shipped, docs, "")
    assert left.columns == docs.columns
    expected = [(1, a), (1, b), (None, c), (None, ""), (None, None), (None, ""), (4, ""), (5, None), (6, long), (8, d)]
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(expected)
    assert corpus_pipeline.drop_near_duplicates(shipped, docs.where("false"), "").count() == 0


def test_equal_prefixes_with_unlike_sets(make):
    rng = random.Random(12)
    # Many copies with changes at few places: groups of one prefix with many members, and chains of links.
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(4)}"
        texts.append(" ".join(copy))
    similarity = jaccard_join.Similarity(3, 90, 100)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(make(texts), similarity).collect()}
    assert found == brute_components(texts, similarity)
