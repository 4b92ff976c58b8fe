"""Registered queries of the text operators: each runs its operator on its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.llm import alignment, binary_ids, decontaminate, jaccard_join, language_id, license_scan, packing, pii, prefix_trie, quality_rules, token_counts, toxicity, url_filters
from cellspark.llm.common import documents, fold, ship

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    counts = [pii.number("_pii_base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.written("_pii_base"), 256).alias("base_sha256"),
        pii.written("_pii_spans").alias("spans"),
    )


# The rules that the query asks for.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    "op8_url_filters",
    r"""
    WITH places AS (
      SELECT page_id,
        CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
        CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
      FROM pages),
    rules(rule_host, rule_path, ruling) AS (
      VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
             ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    fitting AS (
      SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
             max_by(ruling, length(rule_host || rule_path)) AS ruling
      FROM (SELECT DISTINCT host, path FROM places), rules
      WHERE ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path)
      GROUP BY host, path)
    SELECT page_id, host, path, rule, coalesce(ruling, 'allow') AS verdict
    FROM places LEFT JOIN fitting USING (host, path)
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.createDataFrame(URL_RULES, url_filters.RULE_SCHEMA))


@query(
    "op9_quality_rules",
    rf"""
    WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    split AS (
      SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM texts),
    words AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM split),
    grams AS (
      SELECT rid, i, [w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p] AS g
      FROM words WINDOW p AS (PARTITION BY rid ORDER BY i)),
    again AS (
      SELECT rid, i FROM grams WHERE g[5] IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
    covered AS (
      SELECT rid, count(DISTINCT i + k) AS n_repeat_words
      FROM again, (SELECT unnest(range({quality_rules.WINDOW})) AS k) GROUP BY rid),
    counts AS (
      SELECT rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(list_filter(ws, lambda w: lower(w) IN ({", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))}))) AS n_stop,
        len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[!?]')) AS n_marks
      FROM split LEFT JOIN covered USING (rid)),
    judged AS (
      SELECT *, n_words < 10 OR n_repeat_words > 0.20::DOUBLE * n_words AS base_failed,
        coalesce(word_chars / n_words < 2, false) OR coalesce(word_chars / n_words > 14, false)
        OR coalesce(n_symbols / word_chars > 0.10, false) OR coalesce(n_dup_lines / n_lines > 0.50, false)
        OR n_words >= 40 AND n_stop / n_words < 0.02
        OR n_words >= 10 AND (n_upper / word_chars > 0.60 OR n_marks / n_words > 0.60) AS odd
      FROM counts)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT odd AS kept
    FROM judged
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), 1024)


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), 2048)


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(toxicity.labelled_sample(docs, labels, fold("doc_id", 5) != 0, 20_000))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sample = language_id.labelled_sample(docs, fold("doc_id", 3) != 1, 20_000)
    model = language_id.learn(sample, public_tokenizers.path("piece_bpe_32k.model"))
    predicted = language_id.predict(docs, model)
    return predicted.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op4_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = decontaminate.mark(documents(spark, sf_dir).select("doc_id", "text"), items)
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query(
    "op6_jaccard_join",
    """
    WITH RECURSIVE texts AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    sets AS (
      SELECT DISTINCT doc_id, ws[i:i + 2] AS shingle
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM texts WHERE len(ws) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
    met AS (
      SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM sets x JOIN sets y USING (shingle)
      WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS (
      SELECT a, b FROM met JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id WHERE 100 * common >= 90 * (s.n + t.n - common)),
    reach AS (
      SELECT doc_id, doc_id AS other FROM texts UNION SELECT reach.doc_id, b FROM reach JOIN links ON other = a)
    SELECT t.doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM texts t LEFT JOIN sizes s ON t.doc_id = s.doc_id
    JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) c ON t.doc_id = c.doc_id
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir), jaccard_join.Similarity(words=3, num=90, den=100))


@query(
    "op11_conversation_trie",
    """
    WITH turns AS (
      SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, turn FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
      SELECT conv_id, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || t)) AS ts,
        xor(4294967295, list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
          lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 9 AS h
      FROM turns GROUP BY 1),
    rebuilt AS (
      SELECT c.conv_id, list_concat(coalesce(b.ts, [])[1:c.h], c.ts[c.h + 1:]) AS ts
      FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5),
    members AS (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS depth FROM rebuilt),
    nodes AS (
      SELECT ts[1:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ts) = depth), '')) AS ends_sha256
      FROM members GROUP BY 1, 2),
    children AS (SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
    full_nodes AS (
      SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(strlen(n.key[n.depth].t), 0) AS saved
      FROM nodes n LEFT JOIN children c ON n.key = c.key),
    ways AS (SELECT *, unnest(range(depth + 1)) AS up FROM full_nodes),
    totals AS (
      SELECT key[1:up] AS key, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens FROM ways GROUP BY 1)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves::BIGINT AS n_leaves,
      saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
    FROM full_nodes n JOIN totals t ON n.key = t.key LEFT JOIN nodes p ON n.depth > 0 AND p.key = n.key[1:n.depth - 1]
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op12_binary_ids")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = binary_ids.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(documents(spark, sf_dir), a, b)
