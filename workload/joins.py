"""Gene mapping, publication joins, donor joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellspark.functions.hashing import hash_uniform
from cellspark.operators.columns import keep_first
from cellspark.operators.genes import (
    map_genes,
    map_genes_without_table,
    mapping_stats,
    symbol_checks,
    usable_symbols,
)
from cellspark.operators.publications import (
    flag_known_datasets,
    join_publications,
    known_datasets,
    match_rate,
    publication_text,
)
from cellspark.operators.sentences import attach_symbols
from cellspark.operators.splits import donor_age_split, join_split, split_label
from cellspark.session import materialize
from workload.registry import query
from workload.splits import sampled
from workload.tables import collections, expr, hgnc, load, obs, panel_columns, sql, uniform_sql, var


@query("j1_gene_symbol_mapping", sql("SELECT gene_idx, ensembl_gene_id, feature_name, symbol, mapped_via FROM genes"))
def gene_symbol_mapping(spark, folder):
    return map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])


@query(
    "j2_symbols_without_table",
    sql("""
    , named AS (SELECT 'block_' || (gene_idx // 1000) AS dataset_id, gene_idx % 1000 AS pos, * FROM var),
      checked AS (SELECT dataset_id, avg(CASE WHEN feature_name LIKE 'ENS%' THEN 1 ELSE 0 END) < 0.5 AS ok
                  FROM named GROUP BY 1)
    SELECT n.dataset_id, n.gene_idx, coalesce(CASE WHEN ok THEN feature_name END, ensembl_gene_id) AS symbol
    FROM named n JOIN checked c ON n.dataset_id = c.dataset_id"""),
)
def symbols_without_table(spark, folder):
    genes = _genes_by_block(spark, folder)
    return map_genes_without_table(genes).select("dataset_id", F.col("part").alias("gene_idx"), "symbol")


def _genes_by_block(spark, folder):
    genes = var(spark, folder).withColumnRenamed("gene_idx", "part")
    return genes.withColumns(panel_columns(F.col("part")))


@query(
    "a20_symbol_check",
    sql("""
    , named AS (SELECT 'block_' || (gene_idx // 1000) AS dataset_id, gene_idx % 1000 AS pos, * FROM var)
    SELECT dataset_id,
      coalesce(avg(CASE WHEN ensembl_gene_id LIKE 'ENS%' THEN 1 ELSE 0 END) < 0.5, false)
        AS var_names_are_symbols,
      coalesce(avg(CASE WHEN feature_name LIKE 'ENS%' THEN 1 ELSE 0 END) < 0.5, false)
        AS feature_names_are_symbols
    FROM named GROUP BY 1"""),
)
def symbol_check(spark, folder):
    return symbol_checks(_genes_by_block(spark, folder))


@query(
    "j3_publication_join",
    sql("""
    SELECT o.dataset_id, cell_id, coalesce(collection_id, 'nan') AS collection_id,
      coalesce(title, 'nan') AS publication_title, coalesce(doi, 'nan') AS publication_doi,
      coalesce(description, 'nan') AS publication_description, coalesce(contact_name, 'nan') AS publication_contact_name,
      coalesce(contact_email, 'nan') AS publication_contact_email
    FROM obs o LEFT JOIN collections c ON o.dataset_id = c.dataset_id"""),
)
def publication_join(spark, folder):
    cells = obs(spark, folder).select("dataset_id", "cell_id")
    return publication_text(join_publications(cells, collections(spark, folder)))


@query(
    "j4_donor_split_join",
    sql(f"""
    , donors AS (SELECT donor_id, {uniform_sql("donor_id")} AS u FROM (SELECT DISTINCT donor_id FROM obs))
    SELECT cell_id, o.donor_id, CASE WHEN u < 0.05 THEN 'test' ELSE 'train' END AS split
    FROM obs o JOIN donors d ON o.donor_id = d.donor_id"""),
)
def donor_split_join(spark, folder):
    cells = obs(spark, folder).select("cell_id", "donor_id")
    sides = cells.groupBy("donor_id").agg(F.count("*").alias("cells"))
    sides = sides.withColumn("split", split_label(hash_uniform(["donor_id"]), 0.05))
    return join_split(cells, materialize(spark, sides, "sides"), "donor_id")


@query(
    "j5_donor_semi_join",
    sql(f"""
    SELECT cell_id, donor_id FROM obs WHERE donor_id IN (
      SELECT donor_id FROM obs WHERE {uniform_sql("donor_id")} < 0.05)"""),
)
def donor_semi_join(spark, folder):
    cells = obs(spark, folder).select("cell_id", "donor_id")
    test_donors = cells.select("donor_id").distinct().filter(hash_uniform(["donor_id"]) < 0.05)
    return cells.join(test_donors, "donor_id", "left_semi")


@query(
    "j6_dataset_exists",
    sql("""
    SELECT dataset_id, count(*) AS cells, dataset_id IN (SELECT dataset_id FROM collections) AS in_collections
    FROM obs GROUP BY 1"""),
)
def dataset_exists(spark, folder):
    sizes = obs(spark, folder).groupBy("dataset_id").agg(F.count("*").alias("cells"))
    return flag_known_datasets(sizes, collections(spark, folder))


@query(
    "j6_known_dataset_cells",
    sql("SELECT cell_id, dataset_id FROM obs WHERE dataset_id IN (SELECT dataset_id FROM collections)"),
)
def known_dataset_cells(spark, folder):
    return known_datasets(obs(spark, folder).select("cell_id", "dataset_id"), collections(spark, folder))


@query(
    "j7_expression_with_symbols",
    sql("SELECT cell_id, e.gene_idx, value, symbol FROM expr e JOIN genes g ON e.gene_idx = g.gene_idx"),
)
def expression_with_symbols(spark, folder):
    genes = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"]).select("gene_idx", "symbol")
    return attach_symbols(expr(spark, folder), genes, ["gene_idx"])


@query(
    "a13_gene_mapping_stats",
    sql("""
    SELECT count(*) AS total_genes, (count(*) FILTER (mapped_via = 'hgnc'))::BIGINT AS mapped_via_hgnc,
      (count(*) FILTER (mapped_via = 'feature_name'))::BIGINT AS mapped_via_fallback,
      (count(*) FILTER (mapped_via = 'gene_id'))::BIGINT AS unmapped_using_ensembl_id,
      round((count(*) FILTER (mapped_via = 'hgnc'))::DOUBLE * 100 / count(*), 2) AS hgnc_mapping_percentage,
      round((count(*) FILTER (mapped_via = 'feature_name'))::DOUBLE * 100 / count(*), 2) AS fallback_percentage,
      round((count(*) FILTER (mapped_via = 'gene_id'))::DOUBLE * 100 / count(*), 2) AS unmapped_percentage
    FROM genes"""),
)
def gene_mapping_stats(spark, folder):
    return mapping_stats(map_genes(var(spark, folder), hgnc(spark, folder), ["rank"]))


@query(
    "a21_publication_match_rate",
    sql("""
    SELECT count(*) AS total_rows, count(collection_id) AS rows_with_metadata,
      round(count(collection_id)::DOUBLE * 100 / count(*), 2) AS match_percentage
    FROM obs o LEFT JOIN collections c ON o.dataset_id = c.dataset_id"""),
)
def publication_match_rate(spark, folder):
    cells = obs(spark, folder).select("dataset_id")
    return match_rate(join_publications(cells, collections(spark, folder)))


@query(
    "u3_keep_first_symbol",
    sql("SELECT ensembl_gene_id, arg_min(symbol, rank) AS symbol FROM hgnc WHERE symbol IS NOT NULL GROUP BY 1"),
)
def keep_first_symbol(spark, folder):
    return usable_symbols(hgnc(spark, folder), ["rank"])


@query(
    "u3_keep_first_order",
    sql("""
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    WHERE rn = 1"""),
)
def keep_first_order(spark, folder):
    orders = load(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "sp4_donor_split_by_median_age",
    sql("""
    , donors AS (SELECT donor_id, count(*) AS cells, median(age) AS donor_age FROM sampled
                 WHERE age IS NOT NULL GROUP BY 1)
    SELECT donor_id, cells, donor_age,
      CASE WHEN (('0x' || substr(md5('42:' || round(donor_age * 1000)::BIGINT || ':' || donor_id), 1, 8))::BIGINT
                 % 10000) / 10000.0::DOUBLE < 0.05 THEN 'test' ELSE 'train' END AS split
    FROM donors"""),
)
def donor_split_by_median_age(spark, folder):
    return donor_age_split(sampled(spark, folder), "donor_id")
