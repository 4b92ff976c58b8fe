"""Ranking, limits, paging, unions and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellspark.operators.ages import age_distribution, with_age, with_known_age
from cellspark.operators.genes import map_genes
from cellspark.operators.profile import top_genes_of_cell
from cellspark.operators.ranking import with_row_index
from cellspark.operators.sentences import attach_symbols, rank_genes
from cellspark.operators.sets import concat, diagonal_concat, distinct_values
from cellspark.operators.summaries import order_by_known_ages, value_counts
from workload.registry import query
from workload.tables import collections, expr, hgnc, load, obs, sql, var

_RANKED = """
    , ranked AS (
      SELECT cell_id, e.gene_idx, symbol, value, row_number() OVER (
        PARTITION BY cell_id ORDER BY symbol LIKE 'ENS%', value DESC, e.gene_idx DESC) AS rank
      FROM expr e JOIN genes g ON e.gene_idx = g.gene_idx)"""


def symbol_expr(spark, folder):
    genes = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"]).select("gene_idx", "symbol")
    return attach_symbols(expr(spark, folder), genes, ["gene_idx"])


@query("t1_gene_rank", sql(f"{_RANKED} SELECT cell_id, gene_idx, symbol, value, rank FROM ranked"))
def gene_rank(spark, folder):
    return rank_genes(symbol_expr(spark, folder), ["cell_id"])


@query("t2_top_genes", sql(f"{_RANKED} SELECT cell_id, gene_idx, symbol, value, rank FROM ranked WHERE rank <= 2"))
def top_genes(spark, folder):
    return rank_genes(symbol_expr(spark, folder), ["cell_id"], 2)


@query("t3_order_by_count", sql("SELECT cell_type, count(*) AS cells FROM obs GROUP BY 1 ORDER BY 2 DESC, 1"))
def order_by_count(spark, folder):
    return value_counts(obs(spark, folder), "cell_type").orderBy(F.col("cells").desc(), "cell_type")


@query(
    "t4_order_by_age",
    sql("SELECT age, count(*) AS cells FROM sampled WHERE age IS NOT NULL GROUP BY 1 ORDER BY 1"),
)
def order_by_age(spark, folder):
    cells = with_known_age(with_age(obs(spark, folder), "sampling_stage"))
    return age_distribution(cells).orderBy("age")


@query(
    "t5_order_by_filled_key",
    sql("""
    SELECT dataset_id, nullif(count(age), 0) AS cells_with_age FROM aged GROUP BY 1
    ORDER BY coalesce(cells_with_age, 0) DESC, dataset_id"""),
)
def order_by_filled_key(spark, folder):
    ages = with_age(obs(spark, folder)).groupBy("dataset_id").agg(
        F.nullif(F.count("age"), F.lit(0)).alias("cells_with_age")
    )
    return order_by_known_ages(ages, "cells_with_age")


@query("t6_head", sql("SELECT cell_id, tissue FROM obs ORDER BY cell_id LIMIT 10"))
def head(spark, folder):
    return obs(spark, folder).select("cell_id", "tissue").orderBy("cell_id").limit(10)


@query("t7_page", sql("SELECT cell_id, tissue FROM obs ORDER BY cell_id LIMIT 50 OFFSET 100"))
def page(spark, folder):
    return obs(spark, folder).select("cell_id", "tissue").orderBy("cell_id").offset(100).limit(50)


@query("t8_gene_order", sql("SELECT gene_idx, symbol FROM genes ORDER BY gene_idx"))
def gene_order(spark, folder):
    genes = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])
    return genes.select("gene_idx", "symbol").orderBy("gene_idx")


@query(
    "t9_top3_of_largest_cell",
    sql("""
    SELECT cell_id, e.gene_idx, symbol, value FROM expr e JOIN genes g ON e.gene_idx = g.gene_idx
    WHERE cell_id = (SELECT cell_id FROM expr GROUP BY 1 ORDER BY sum(value) DESC, cell_id LIMIT 1)
    ORDER BY value DESC, e.gene_idx DESC LIMIT 3"""),
)
def top3_of_largest_cell(spark, folder):
    totals = expr(spark, folder).groupBy("cell_id").agg(F.sum("value").alias("total"))
    largest = totals.orderBy(F.col("total").desc(), "cell_id").first()["cell_id"]
    return top_genes_of_cell(symbol_expr(spark, folder), "cell_id", largest)


@query("p14_row_index", sql("SELECT cell_id, row_number() OVER (ORDER BY cell_id) - 1 AS row_idx FROM obs"))
def row_index(spark, folder):
    return with_row_index(obs(spark, folder).select("cell_id"), "cell_id")


@query(
    "u1_concat",
    sql("""
    SELECT organism, count(*) AS cells FROM (
      SELECT organism FROM obs WHERE organism = 'Homo sapiens' UNION ALL
      SELECT organism FROM obs WHERE organism = 'Mus musculus' UNION ALL
      SELECT organism FROM obs WHERE organism = 'unknown') GROUP BY 1"""),
)
def concat_species(spark, folder):
    cells = obs(spark, folder).select("organism", "cell_id")
    parts = [cells.filter(F.col("organism") == o) for o in ("Homo sapiens", "Mus musculus", "unknown")]
    return value_counts(concat(*parts), "organism")


@query(
    "u2_diagonal_concat",
    sql("""
    SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS kind, NULL::VARCHAR AS name FROM orders
    UNION ALL SELECT c_custkey, c_acctbal, c_nationkey::VARCHAR, c_name FROM customer
    UNION ALL SELECT n_nationkey, n_regionkey::DOUBLE, NULL, n_name FROM nation"""),
)
def diagonal(spark, folder):
    """Missing columns are null, int and double give double, int and text give text."""
    orders = load(spark, folder, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS amount", "o_orderstatus AS kind")
    donors = load(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_acctbal AS amount", "c_nationkey AS kind", "c_name AS name"
    )
    nations = load(spark, folder, "nation").selectExpr("n_nationkey AS id", "n_regionkey AS amount", "n_name AS name")
    return diagonal_concat(orders, donors, nations)


@query("u4_distinct_values", sql("SELECT DISTINCT donor_id FROM obs"))
def distinct_donors(spark, folder):
    return distinct_values(obs(spark, folder), "donor_id")


@query(
    "u7_missing_datasets",
    sql("SELECT dataset_id FROM obs EXCEPT SELECT dataset_id FROM collections"),
)
def missing_datasets(spark, folder):
    return obs(spark, folder).select("dataset_id").subtract(collections(spark, folder).select("dataset_id"))
