"""Filters and predicates."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from cellspark.functions.hashing import hash_uniform
from cellspark.operators.ages import age_range_violations, with_age, with_known_age
from cellspark.operators.genes import flag_lists, map_genes, without_ensembl
from cellspark.operators.inventory import filter_by_size, filter_unfinished, older_than
from cellspark.operators.publications import portal_datasets
from cellspark.operators.sentences import sentence_quality, top_sentences
from workload.registry import query
from workload.sorts import symbol_expr
from workload.tables import files, gene_lists, hgnc, load, obs, outputs, sql, uniform_sql, var


@query("f1_known_age", sql("SELECT cell_id, age FROM aged WHERE age IS NOT NULL"))
def known_age(spark, folder):
    return with_known_age(with_age(obs(spark, folder))).select("cell_id", "age")


@query("f2_without_ensembl", sql("SELECT gene_idx, symbol FROM genes WHERE symbol NOT LIKE 'ENS%'"))
def drop_ensembl(spark, folder):
    genes = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])
    return without_ensembl(genes).select("gene_idx", "symbol")


@query(
    "f3_gene_list_members",
    sql("""
    SELECT gene_idx, symbol, symbol IN (SELECT symbol FROM gene_lists WHERE list_name = 'small') AS in_small,
      symbol IN (SELECT symbol FROM gene_lists WHERE list_name = 'brand1') AS in_brand1 FROM genes"""),
)
def gene_list_members(spark, folder):
    genes = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"]).select("gene_idx", "symbol")
    return flag_lists(genes, gene_lists(spark, folder, genes), ["small", "brand1"])


@query(
    "f3_expression_of_list_genes",
    sql("""
    SELECT cell_id, e.gene_idx, symbol, value FROM expr e JOIN genes g ON e.gene_idx = g.gene_idx
    WHERE symbol IN (SELECT symbol FROM gene_lists WHERE list_name = 'brand1')"""),
)
def expression_of_list_genes(spark, folder):
    genes = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"]).select("gene_idx", "symbol")
    members = gene_lists(spark, folder, genes).filter(F.col("list_name") == "brand1").select("symbol")
    return symbol_expr(spark, folder).join(members, "symbol", "left_semi")


@query(
    "f4_equality_filters",
    sql("SELECT cell_id, tissue FROM obs WHERE organism = 'Mus musculus' AND disease = 'F'"),
)
def equality_filters(spark, folder):
    chosen = (F.col("organism") == "Mus musculus") & (F.col("disease") == "F")
    return obs(spark, folder).filter(chosen).select("cell_id", "tissue")


@query(
    "f5_f6_threshold_filters",
    sql(f"""
    , u AS (SELECT {uniform_sql("cell_id")} AS u FROM obs)
    SELECT 'train' AS side, count(*) AS cells FROM u WHERE u >= 0.05
    UNION ALL SELECT 'test', count(*) FROM u WHERE NOT (u >= 0.05)"""),
)
def threshold_filters(spark, folder):
    train = hash_uniform(["cell_id"]) >= 0.05
    side = F.when(train, "train").otherwise("test")
    return obs(spark, folder).groupBy(side.alias("side")).agg(F.count("*").alias("cells"))


@query(
    "f7_complete_keys",
    sql("SELECT ensembl_gene_id, symbol, rank FROM hgnc WHERE ensembl_gene_id IS NOT NULL AND symbol IS NOT NULL"),
)
def complete_keys(spark, folder):
    return hgnc(spark, folder).filter(F.col("ensembl_gene_id").isNotNull() & F.col("symbol").isNotNull())


@query("f8_size_limit", sql("SELECT path, length FROM files WHERE length / 1048576.0 <= 0.005"))
def size_limit(spark, folder):
    return filter_by_size(files(spark, folder), 0.005).select("path", "length")


@query(
    "f9_unfinished_files",
    sql(r"""
    SELECT lang || '_set_' || doc_id AS dataset_name, path FROM files
    WHERE lang || '_set_' || doc_id NOT IN (SELECT split_part(path, '/', 3) FROM outputs)"""),
)
def unfinished_files(spark, folder):
    waiting = filter_unfinished(files(spark, folder), outputs(spark, folder))
    return waiting.select("dataset_name", "path")


@query(
    "f10_portal_pages",
    sql("""
    , moved AS (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN replace(url, 'example', 'CellxGene') ELSE url END AS url FROM pages)
    SELECT page_id, url FROM moved WHERE lower(url) LIKE '%cellxgene%' OR lower(url) LIKE '%cziscience%'"""),
)
def portal_pages(spark, folder):
    """One page in four is moved to the portal first."""
    moved = F.when(F.col("page_id") % 4 == 0, F.replace("url", F.lit("example"), F.lit("CellxGene"))).otherwise(F.col("url"))
    return portal_datasets(load(spark, folder, "pages").select("page_id", moved.alias("url")), "url")


@query(
    "f12_sentence_quality",
    sql("""
    , ranked AS (
      SELECT cell_id, e.gene_idx, symbol, value, row_number() OVER (
        PARTITION BY cell_id ORDER BY symbol LIKE 'ENS%', value DESC, e.gene_idx DESC) AS rank
      FROM expr e JOIN genes g ON e.gene_idx = g.gene_idx)
    , sentences AS (SELECT cell_id, coalesce(string_agg(symbol, ' ' ORDER BY rank)
        FILTER (rank <= 5 AND symbol NOT LIKE 'ENS%'), '') || CASE WHEN cell_id % 5 = 0 THEN ' ENSG1' ELSE '' END AS s
      FROM ranked GROUP BY 1)
    SELECT count(*) AS sentences, (count(*) FILTER (length(s) = 0))::BIGINT AS empty,
      (count(*) FILTER (regexp_matches(s, 'ENS[A-Z]*[0-9]+')))::BIGINT AS with_ensembl_token,
      max(length(s))::INTEGER AS longest FROM sentences"""),
)
def quality(spark, folder):
    """One sentence in five gets a token that does not belong there."""
    sentences = top_sentences(symbol_expr(spark, folder), ["cell_id"], 5)
    spoilt = F.concat("gene_sentence_5", F.when(F.col("cell_id") % 5 == 0, F.lit(" ENSG1")).otherwise(F.lit("")))
    return sentence_quality(sentences.withColumn("gene_sentence_5", spoilt), "gene_sentence_5")


@query(
    "f13_age_range",
    sql("""
    , wrong AS (SELECT CASE WHEN cell_id % 7 = 0 THEN age + 120 ELSE age END AS age FROM sampled)
    SELECT min(age) AS age_min, max(age) AS age_max, (count(*) FILTER (age < 0 OR age > 150))::BIGINT AS out_of_range
    FROM wrong"""),
)
def age_range(spark, folder):
    """One cell in seven is made too old first."""
    cells = with_age(obs(spark, folder), "sampling_stage")
    wrong = F.when(F.col("cell_id") % 7 == 0, F.col("age") + 120).otherwise(F.col("age"))
    return age_range_violations(cells.withColumn("age", wrong))


@query(
    "f14_old_rows",
    sql("SELECT event_id, ts AS modified FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 7 DAY"),
)
def old_rows(spark, folder):
    events = load(spark, folder, "events").withColumn("modificationTime", F.col("ts").cast("timestamp"))
    now = F.lit(datetime.datetime(2024, 1, 25, tzinfo=datetime.UTC)).cast("timestamp")
    return older_than(events, 7, now).select("event_id", F.col("ts").alias("modified"))
