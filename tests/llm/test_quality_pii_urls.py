import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellspark.llm import pii, quality_rules, queries, url_filters


def repeated_words(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)})


def test_quality_counts(odd, make):
    texts = ["a b c d e f g a b c d e h", "a b c d e a b c d e a b c d e", "l1 x\nl2\nl1 x\n\n l1 x\nl1 x", "#* || $ <a> 100%", "ÀB\x0bcd\x85ef"]
    docs = make(texts).unionByName(odd)
    expected = []
    for row in docs.collect():
        text = row["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        expected.append((row["doc_id"], len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeated_words(words)))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = [tuple(r) for r in quality_rules.judge(docs).select(columns).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_quality_verdicts(make, empty):
    good = "The river runs through the old town and the people walk along it in the evening. " + "They talk of the day and of the weather. "
    docs = make([good, "buy " * 50, "SHOUT!! " * 30, "a | b | c | d | e | f | g | h | i | j", "short"])
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs).collect()}
    assert kept == {0: True, 1: False, 2: False, 3: False, 4: False}
    assert quality_rules.judge(empty).count() == 0


def test_rules_are_one_projection(make):
    plan = quality_rules.judge(make(["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


PII_TEXTS = [
    "mail a.b@c.org, x@y and p@q.r.s@t.u then 10.0.0.1 or 1.2.3.4.5.6.7.8 and 256.1.1.1 and 0010.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 4041894974608795; +1 (988) 555-2485 or +49 30 1234567 8",
    "é+12 345 678 901 @ a@b.c-d_e@f.g 1.2.3",
    "+1+2+3 99 " + "7" * 50 + " a%b@c.d.",
    "write to someone(at)host.example(dot)com",
]


def base_spans(text):
    def luhn(digits):
        return sum(d * (1 + i % 2) - 9 * (d * (1 + i % 2) > 9) for i, d in enumerate(int(c) for c in reversed(digits))) % 10 == 0

    def digits(m):
        return re.sub(r"[^0-9]", "", m)

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    found = [(m.start(), rank, m.end(), kind) for rank, (kind, rx, ok) in enumerate(kinds) for m in re.finditer(rx, text) if ok(m[0])]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def test_base_spans(make, odd):
    docs = make(PII_TEXTS).unionByName(odd)
    found = pii.find(docs, {k: pii.Trees() for k in pii.KINDS}).select("text", pii.written("_pii_base").alias("base"), pii.written("_pii_spans").alias("all"))
    for row in found.collect():
        assert row["base"] == row["all"] == ",".join(base_spans(row["text"] or ""))


def test_boosted_trees_add_spans(make):
    numbers = [f"call me +1 ({200 + i}) 555-{1000 + i} today" for i in range(600)]
    others = [f"version 1.2.3.4.{i} of item 2020-01-{10 + i % 20} 1234567890123 in list" for i in range(300)]
    docs = make([*numbers, *others, "call me (988) 555-2485 today", "plain words"])
    models = pii.fit(docs)
    assert models["phone"].threshold < float("inf")
    spans = {r["text"]: r["spans"] for r in pii.find(docs, models).select("text", pii.written("_pii_spans").alias("spans")).collect()}
    assert spans["call me (988) 555-2485 today"] == "phone:8:22"
    assert spans["plain words"] == "" and "phone" not in spans[others[0]]
    redacted = pii.redact(docs, models)
    assert redacted.columns == docs.columns
    texts = {r["text"] for r in redacted.collect()}
    assert {"call me <phone> today", "plain words"} <= texts and not any("555" in t for t in texts)


def test_redaction_of_odd_rows(odd, empty):
    models = pii.fit(odd)
    assert sorted(map(repr, pii.redact(odd, models).collect())) == sorted(map(repr, odd.collect()))
    assert pii.redact(empty, pii.fit(empty)).count() == 0
    overlapping = odd.limit(1).withColumn("text", F.lit("é 1.2.3.4 x +1.2.3.4567890 y"))
    assert [r["text"] for r in pii.redact(overlapping, models).collect()] == ["é <ip> x <phone> y"]


def test_pii_query_digest(shipped, tmp_path, make):
    make(PII_TEXTS).write.parquet(f"{tmp_path}/documents.parquet")
    for row in queries.QUERIES["op3_pii"](shipped, str(tmp_path)).collect():
        spans = base_spans(PII_TEXTS[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in spans) for k in pii.KINDS]
        assert set(spans) <= set(row["spans"].split(","))


CANONICAL = '<html><link rel="canonical" href="{}"></html>'
REFRESH = '<meta http-equiv="refresh" content="0; url={}">'


def test_url_filters(shipped):
    pages = [
        (1, "https://A.Example.ORG/es/1?x#f", ""),
        (2, "https://other.net/a", CANONICAL.format("https://blocked.com/de/x")),
        (3, "https://third.net/b", REFRESH.format("http://other.net/a#top")),
        (4, "https://free.net/c", CANONICAL.format("/d")),
        (5, "https://free.net/d", REFRESH.format("https://x.com/fr/9")),
        (6, "https://mixed.net/e", CANONICAL.format("https://x.com/fr/8")),
        (7, "https://mixed.net/f", CANONICAL.format("https://mixed.net/e") + REFRESH.format("https://x.com/de/8")),
        (8, "no scheme", None),
        (9, None, CANONICAL.format("https://blocked.com/de/x")),
        (10, "http://x.example.org/en/12", ""),
        (10, "http://x.example.org/en/12", ""),
        (11, "http://example.org", ""),
        (12, "http://notexample.org/es/1", ""),
    ]
    table = shipped.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    rules = shipped.createDataFrame(queries.URL_RULES, url_filters.RULE_SCHEMA)
    found = url_filters.judge(table, rules).collect()
    assert len(found) == len(pages)
    verdicts = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}
    assert verdicts == {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"),
        2: ("other.net", "/a", None, "block"),
        3: ("third.net", "/b", None, "block"),
        4: ("free.net", "/c", None, "allow"),
        5: ("free.net", "/d", None, "allow"),
        6: ("mixed.net", "/e", None, "allow"),
        7: ("mixed.net", "/f", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("x.example.org", "/en/12", "example.org/en/1", "block"),
        11: ("example.org", "", None, "allow"),
        12: ("notexample.org", "/es/1", "org/", "allow"),
    }
    assert url_filters.judge(table.where("false"), rules).count() == 0


@pytest.mark.parametrize("name", ["op3_pii", "op8_url_filters", "op9_quality_rules"])
def test_native(shipped, name):
    plan = queries.QUERIES[name](shipped, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)
