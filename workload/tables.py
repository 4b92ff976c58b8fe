"""Domain tables made from the benchmark tables: cells are orders, genes are parts.

Each table is written twice, as DataFrame code for Spark and as SQL for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.operators.joins import deal_groups, deal_rows


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def obs(spark: SparkSession, folder: str, orders: DataFrame | None = None) -> DataFrame:
    """One cell per order; the donor is the customer, the dataset is the customer's nation."""
    orders = load(spark, folder, "orders") if orders is None else orders
    donors = load(spark, folder, "customer").join(
        load(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    cells = orders.join(donors, F.col("o_custkey") == F.col("c_custkey"))
    region = F.col("n_regionkey")
    organism = F.when(region == 3, "Mus musculus").when(region == 4, "unknown").otherwise("Homo sapiens")
    base = 20 + 5 * F.floor((F.col("c_acctbal") + 1000) / 1000)
    later = F.year("o_orderdate") - 1995
    months = _text((1 + F.floor((F.col("c_acctbal") + 1000) / 500)), "m")
    unknown = F.col("o_orderpriority") == "4-NOT SPECIFIED"

    def stage(years: Column) -> Column:
        return F.when(unknown, "unknown").when(region == 3, months).otherwise(_text(years, "-year-old human stage"))

    price = F.col("o_totalprice")
    return cells.select(
        _text("ds_", F.col("c_nationkey")).alias("dataset_id"),
        F.col("o_orderkey").alias("cell_id"),
        _text("donor_", F.col("o_custkey")).alias("donor_id"),
        organism.alias("organism"),
        stage(base).alias("development_stage"),
        stage(base + later).alias("sampling_stage"),
        F.col("c_mktsegment").alias("tissue"),
        F.col("o_orderpriority").alias("cell_type"),
        F.col("o_orderstatus").alias("disease"),
        F.when(F.col("o_custkey") % 2 == 0, "female").otherwise("male").alias("sex"),
        F.when(price >= 50000, F.when(price < 250000, "10x 3' v2").otherwise("10x 3' v3")).alias("assay"),
    )


def _items(spark: SparkSession, folder: str, cell: str) -> DataFrame:
    return load(spark, folder, "lineitem").select(F.col(cell).alias("cell_id"), F.col("l_partkey").alias("gene_idx"), "l_quantity")


def expr(spark: SparkSession, folder: str, cell: str = "l_orderkey", by: tuple[str, ...] = ("cell_id", "gene_idx")) -> DataFrame:
    """Long-form expression: summed quantity per cell and part, dealt by ``by``."""
    return deal_rows(_items(spark, folder, cell), list(by)).groupBy("cell_id", "gene_idx").agg(F.sum("l_quantity").alias("value"))


PANEL = 1000


def panel_columns(part: Column) -> dict[str, Column]:
    """A thousand parts in turn are the genes of one dataset, numbered from 0."""
    return {"dataset_id": _text("block_", F.floor(part / PANEL)), "gene_idx": part % PANEL}


def panel_expr(spark: SparkSession, folder: str, cell: str) -> DataFrame:
    """Expression by dataset: what a cell has of the thousand parts of each dataset. Rows move once, to their dataset or cell."""
    items = _items(spark, folder, cell).withColumns(panel_columns(F.col("gene_idx")))
    rows = deal_groups(items, "dataset_id", ["cell_id"]).groupBy("dataset_id", "cell_id", "gene_idx")
    return rows.agg(F.sum("l_quantity").alias("value")).select("cell_id", "gene_idx", "value", "dataset_id")


def donor_expr(spark: SparkSession, folder: str) -> DataFrame:
    """Expression with the customer as the cell."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    items = load(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return items.groupBy(F.col("o_custkey").alias("cell_id"), F.col("l_partkey").alias("gene_idx")).agg(
        F.sum("l_quantity").alias("value")
    )


def _ensembl_id() -> Column:
    return _text("ENSG", F.lpad(F.col("p_partkey").cast("string"), 11, "0"))


def var(spark: SparkSession, folder: str) -> DataFrame:
    feature = _text("F_", F.replace("p_name", F.lit(" "), F.lit("_")), "_", F.col("p_partkey"))
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("gene_idx"),
        _ensembl_id().alias("ensembl_gene_id"),
        F.when(F.col("p_size") <= 25, feature).otherwise(_ensembl_id()).alias("feature_name"),
    )


def hgnc(spark: SparkSession, folder: str) -> DataFrame:
    """Symbols; none for promo parts, a second one for two brands."""
    part = load(spark, folder, "part")
    first = F.when(F.col("p_type") != "PROMO", _text("G", F.col("p_partkey")))
    main = part.select(_ensembl_id().alias("ensembl_gene_id"), first.alias("symbol"), F.lit(1).alias("rank"))
    more = part.filter(F.col("p_brand").isin("Brand#7", "Brand#8")).select(
        _ensembl_id().alias("ensembl_gene_id"), _text("ALT", F.col("p_partkey")).alias("symbol"), F.lit(2).alias("rank")
    )
    return main.unionByName(more)


def gene_lists(spark: SparkSession, folder: str, genes: DataFrame) -> DataFrame:
    """Two lists: symbols of small parts and symbols of one brand."""
    part = load(spark, folder, "part").select(F.col("p_partkey").alias("gene_idx"), "p_size", "p_brand")
    names = F.array(F.when(F.col("p_size") <= 10, "small"), F.when(F.col("p_brand") == "Brand#1", "brand1"))
    listed = part.select("gene_idx", F.explode(F.array_compact(names)).alias("list_name"))
    return genes.select("gene_idx", "symbol").join(listed, "gene_idx").select("list_name", "symbol")


def collections(spark: SparkSession, folder: str) -> DataFrame:
    """Publication records of the datasets of four regions out of five."""
    nations = load(spark, folder, "nation").filter(F.col("n_regionkey") != 2)
    joined = nations.join(load(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        _text("ds_", F.col("n_nationkey")).alias("dataset_id"),
        _text("col_", F.col("r_regionkey")).alias("collection_id"),
        F.col("r_name").alias("title"),
        F.when(F.col("r_name") != "EUROPE", _text("10.1000/", F.col("n_nationkey"))).alias("doi"),
        _text("Cells of ", F.col("r_name")).alias("description"),
        F.col("n_name").alias("contact_name"),
        _text(F.lower("n_name"), "@example.org").alias("contact_email"),
    )


def files(spark: SparkSession, folder: str) -> DataFrame:
    """File inventory: each document is a file, its text length in bytes the file size."""
    return load(spark, folder, "documents").select(
        _text("/data/", F.col("source"), "/", F.col("lang"), " set#", F.col("doc_id"), ".h5ad").alias("path"),
        F.octet_length("text").cast("bigint").alias("length"),
        "doc_id",
        "source",
        "lang",
    )


def outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Output inventory: one Parquet file for each labelled document."""
    named = load(spark, folder, "documents").join(load(spark, folder, "labels"), "doc_id")
    side = F.when(F.col("quality") == 1, "train").otherwise("test")
    return named.select(
        _text("/out/", F.col("lang"), "_set_", F.col("doc_id"), "/", side, "/chunk_0000.parquet").alias("path"),
        F.octet_length("text").cast("bigint").alias("length"),
        side.alias("split"),
    )


SQL_TABLES = """
WITH obs AS (
  SELECT 'ds_' || c_nationkey AS dataset_id, o_orderkey AS cell_id, 'donor_' || o_custkey AS donor_id,
    CASE n_regionkey WHEN 3 THEN 'Mus musculus' WHEN 4 THEN 'unknown' ELSE 'Homo sapiens' END AS organism,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
         WHEN n_regionkey = 3 THEN (1 + floor((c_acctbal + 1000) / 500))::BIGINT || 'm'
         ELSE (20 + 5 * floor((c_acctbal + 1000) / 1000))::BIGINT || '-year-old human stage'
    END AS development_stage,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
         WHEN n_regionkey = 3 THEN (1 + floor((c_acctbal + 1000) / 500))::BIGINT || 'm'
         ELSE (20 + 5 * floor((c_acctbal + 1000) / 1000) + year(o_orderdate) - 1995)::BIGINT
              || '-year-old human stage'
    END AS sampling_stage,
    c_mktsegment AS tissue, o_orderpriority AS cell_type, o_orderstatus AS disease,
    CASE WHEN o_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
    CASE WHEN o_totalprice >= 50000 THEN
      CASE WHEN o_totalprice < 250000 THEN '10x 3'' v2' ELSE '10x 3'' v3' END END AS assay
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), aged AS (
  SELECT *, try_cast(nullif(regexp_extract(development_stage, '([0-9]+(?:[.][0-9]+)?)-year-old', 1), '') AS DOUBLE) AS age
  FROM obs
), sampled AS (
  SELECT * EXCLUDE (age),
    try_cast(nullif(regexp_extract(sampling_stage, '([0-9]+(?:[.][0-9]+)?)-year-old', 1), '') AS DOUBLE) AS age
  FROM aged
), meta AS (
  SELECT *,
    CASE WHEN organism = 'Homo sapiens' THEN
      try_cast(nullif(regexp_extract(sampling_stage, '([0-9]+(?:[.][0-9]+)?)-year-old', 1), '') AS DOUBLE) END AS age_years,
    CASE WHEN organism = 'Mus musculus' THEN
      try_cast(nullif(regexp_extract(sampling_stage, '([0-9]+(?:[.][0-9]+)?)[ ]*-?[ ]*m', 1), '') AS DOUBLE) END AS age_months
  FROM obs
), expr AS (
  SELECT l_orderkey AS cell_id, l_partkey AS gene_idx, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2
), donor_expr AS (
  SELECT o_custkey AS cell_id, l_partkey AS gene_idx, sum(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
), supplier_expr AS (
  SELECT l_suppkey AS cell_id, l_partkey AS gene_idx, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2
), panel_expr AS (
  SELECT 'block_' || (gene_idx // 1000) AS dataset_id, * FROM expr
), panel_supplier_expr AS (
  SELECT 'block_' || (gene_idx // 1000) AS dataset_id, * FROM supplier_expr
), var AS (
  SELECT p_partkey AS gene_idx, 'ENSG' || lpad(p_partkey::VARCHAR, 11, '0') AS ensembl_gene_id,
    CASE WHEN p_size <= 25 THEN 'F_' || replace(p_name, ' ', '_') || '_' || p_partkey
         ELSE 'ENSG' || lpad(p_partkey::VARCHAR, 11, '0') END AS feature_name
  FROM part
), hgnc AS (
  SELECT 'ENSG' || lpad(p_partkey::VARCHAR, 11, '0') AS ensembl_gene_id,
    CASE WHEN p_type <> 'PROMO' THEN 'G' || p_partkey END AS symbol, 1 AS rank FROM part
  UNION ALL
  SELECT 'ENSG' || lpad(p_partkey::VARCHAR, 11, '0'), 'ALT' || p_partkey, 2 FROM part
  WHERE p_brand IN ('Brand#7', 'Brand#8')
), genes AS (
  SELECT v.*, coalesce(h.symbol, CASE WHEN feature_name NOT LIKE 'ENS%' THEN feature_name END, v.ensembl_gene_id) AS symbol,
    CASE WHEN h.symbol IS NOT NULL THEN 'hgnc' WHEN feature_name NOT LIKE 'ENS%' THEN 'feature_name' ELSE 'gene_id' END
      AS mapped_via
  FROM var v LEFT JOIN (
    SELECT ensembl_gene_id, arg_min(symbol, rank) AS symbol FROM hgnc WHERE symbol IS NOT NULL GROUP BY 1
  ) h ON v.ensembl_gene_id = h.ensembl_gene_id
), gene_lists AS (
  SELECT 'small' AS list_name, symbol FROM genes JOIN part ON gene_idx = p_partkey WHERE p_size <= 10
  UNION ALL
  SELECT 'brand1', symbol FROM genes JOIN part ON gene_idx = p_partkey WHERE p_brand = 'Brand#1'
), collections AS (
  SELECT 'ds_' || n_nationkey AS dataset_id, 'col_' || r_regionkey AS collection_id, r_name AS title,
    CASE WHEN r_name <> 'EUROPE' THEN '10.1000/' || n_nationkey END AS doi, 'Cells of ' || r_name AS description,
    n_name AS contact_name, lower(n_name) || '@example.org' AS contact_email
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <> 2
), files AS (
  SELECT '/data/' || source || '/' || lang || ' set#' || doc_id || '.h5ad' AS path,
    strlen(text)::BIGINT AS length, doc_id, source, lang FROM documents
), outputs AS (
  SELECT '/out/' || lang || '_set_' || d.doc_id || '/' || CASE WHEN quality = 1 THEN 'train' ELSE 'test' END
    || '/chunk_0000.parquet' AS path, strlen(text)::BIGINT AS length,
    CASE WHEN quality = 1 THEN 'train' ELSE 'test' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""


def sql(body: str) -> str:
    """A full statement: the domain tables as CTEs, then ``body`` (``SELECT`` or ``, name AS (...) SELECT``)."""
    return f"{SQL_TABLES}\n{body.strip()}"


def uniform_sql(key: str, seed: int = 42) -> str:
    """SQL for :func:`cellspark.functions.hashing.hash_uniform`; ``key`` is the joined key text."""
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT % 10000) / 10000.0::DOUBLE"
