"""Column selection, typing and null handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellspark.operators.ages import with_species_ages
from cellspark.operators.columns import (
    DONOR_COLUMNS,
    TISSUE_COLUMNS,
    attach_by_position,
    attach_scalar,
    cast_to_schema,
    decode_codes,
    decode_codes_by_join,
    decode_mask,
    ensure_columns,
    fill_missing_text,
    first_present,
    sample_rows,
    schema_from_encodings,
    select_fields,
    type_untyped_columns,
)
from cellspark.operators.publications import join_publications, publication_text
from workload.registry import query
from workload.tables import collections, load, obs, sql


@query("p1_field_selection", sql("SELECT cell_id, tissue, sex FROM obs"))
def field_selection(spark, folder):
    return select_fields(obs(spark, folder), ["cell_id", "tissue", "not_there", "sex"])


@query(
    "p2_p3_cast_to_schema",
    """SELECT o_orderkey, try_cast(o_orderpriority AS BIGINT) AS o_orderpriority,
      try_cast(left(o_orderpriority, 1) AS BIGINT) AS level, o_totalprice, o_orderstatus FROM orders""",
)
def casts(spark, folder):
    """Types from storage encodings; text that is no number becomes null."""
    schema = schema_from_encodings(
        {
            "index": ("array", "i"),
            "o_orderpriority": ("nullable-integer", None),
            "level": ("array", "u"),
            "o_totalprice": ("array", "f"),
            "o_orderstatus": ("categorical", None),
            "nested": ("dict", None),
        }
    )
    orders = load(spark, folder, "orders").withColumn("level", F.substring("o_orderpriority", 1, 1))
    return cast_to_schema(orders, schema).select(
        "o_orderkey", "o_orderpriority", "level", "o_totalprice", "o_orderstatus"
    )


@query("p4_fill_missing_text", sql("SELECT cell_id, coalesce(assay, 'nan') AS assay, age_years FROM meta"))
def filled_text(spark, folder):
    cells = with_species_ages(obs(spark, folder), "sampling_stage").select("cell_id", "assay", "age_years")
    return fill_missing_text(cells)


@query(
    "p5_decode_categories",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 50000 THEN
      ['F', 'O', 'P'][CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END] END AS status FROM orders""",
)
def decoded_categories(spark, folder):
    code = F.when(F.col("o_totalprice") < 50000, -1).otherwise(
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    )
    categories = F.array(F.lit("F"), F.lit("O"), F.lit("P"))
    return load(spark, folder, "orders").select("o_orderkey", decode_codes(code, categories).alias("status"))


@query(
    "p5_decode_categories_by_join",
    "SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def joined_categories(spark, folder):
    dictionary = load(spark, folder, "nation").selectExpr("n_nationkey AS code", "n_name AS category")
    coded = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return decode_codes_by_join(coded, "c_nationkey", dictionary, "nation")


@query(
    "p6_decode_mask",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
      CASE WHEN o_orderstatus <> 'P' THEN o_totalprice > 100000 END AS large FROM orders""",
)
def decoded_mask(spark, folder):
    masked = F.col("o_orderstatus") == "P"
    return load(spark, folder, "orders").select(
        "o_orderkey",
        decode_mask(F.col("o_totalprice"), masked).alias("price"),
        decode_mask(F.col("o_totalprice") > 100000, masked).alias("large"),
    )


@query("p7_constant_column", sql("SELECT cell_id, 'one_dataset' AS dataset_id FROM obs"))
def constant_column(spark, folder):
    return obs(spark, folder).select("cell_id").withColumn("dataset_id", F.lit("one_dataset"))


@query(
    "p8_rename",
    sql("SELECT dataset_id, title AS publication_title, doi AS publication_doi FROM collections"),
)
def renamed(spark, folder):
    names = {"title": "publication_title", "doi": "publication_doi"}
    return collections(spark, folder).select("dataset_id", "title", "doi").withColumnsRenamed(names)


@query("p9_type_untyped_columns", "SELECT o_orderkey, NULL::BIGINT AS count, NULL::VARCHAR AS note FROM orders")
def typed_nulls(spark, folder):
    schema = schema_from_encodings({"count": ("nullable-integer", None), "note": ("categorical", None)})
    orders = load(spark, folder, "orders").select("o_orderkey", F.lit(None).alias("count"), F.lit(None).alias("note"))
    return type_untyped_columns(orders, schema)


@query("p10_drop_column", sql("SELECT cell_id, donor_id FROM obs"))
def dropped(spark, folder):
    return obs(spark, folder).select("cell_id", "donor_id", "tissue").drop("tissue")


@query("p11_candidate_columns", sql("SELECT cell_id, donor_id AS donor, tissue FROM obs"))
def candidates(spark, folder):
    cells = obs(spark, folder)
    donor, tissue = first_present(cells, DONOR_COLUMNS), first_present(cells, TISSUE_COLUMNS)
    return cells.select("cell_id", F.col(donor).alias("donor"), F.col(tissue).alias("tissue"))


@query(
    "p12_attach_by_position",
    """SELECT p_partkey, n.n_name AS name, (SELECT max(r_name) FROM region) AS region
    FROM part LEFT JOIN (SELECT n_nationkey, n_name FROM nation) n ON p_partkey = n_nationkey""",
)
def attached(spark, folder):
    """A stored column by row position and a stored scalar on every row."""
    rows = load(spark, folder, "part").select("p_partkey")
    stored = load(spark, folder, "nation").select("n_nationkey", "n_name")
    scalar = load(spark, folder, "region").agg(F.max("r_name").alias("value"))
    return attach_scalar(attach_by_position(rows, "p_partkey", stored, "name"), scalar, "region")


@query("p13_ensure_age_columns", sql("SELECT cell_id, NULL::DOUBLE AS age_years, NULL::DOUBLE AS age_months FROM obs"))
def ensured(spark, folder):
    cells = obs(spark, folder).select("cell_id")
    return ensure_columns(cells, {"age_years": "double", "age_months": "double"})


@query(
    "p15_publication_text",
    sql("""
    SELECT o.dataset_id, count(*) AS cells, coalesce(collection_id, 'nan') AS collection_id,
      coalesce(doi, 'nan') AS publication_doi FROM obs o LEFT JOIN collections c ON o.dataset_id = c.dataset_id
    GROUP BY ALL"""),
)
def publication_texts(spark, folder):
    cells = publication_text(join_publications(obs(spark, folder).select("dataset_id"), collections(spark, folder)))
    return cells.groupBy("dataset_id", "collection_id", "publication_doi").agg(F.count("*").alias("cells"))


@query(
    "p16_sample_rows",
    """SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...[truncated]' ELSE text END AS text,
      list_transform(range(0, 8), lambda i: doc_id + i) AS items FROM documents ORDER BY doc_id LIMIT 5""",
)
def sampled_rows(spark, folder):
    documents = load(spark, folder, "documents").select(
        "doc_id", "text", F.sequence(F.col("doc_id"), F.col("doc_id") + 99).alias("items")
    )
    return sample_rows(documents, ["doc_id"])
