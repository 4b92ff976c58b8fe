"""Scalar functions on whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellspark.functions.ages import age_in_months, age_in_years
from cellspark.functions.hashing import hash_uniform
from cellspark.functions.text import (
    dataset_id_from_path,
    gigabytes,
    has_ensembl_token,
    hms,
    is_ensembl_id,
    is_uuid,
    looks_like_portal_path,
    megabytes,
    organism_key,
    path_stem,
    percent,
    sanitize_name,
    truncated,
    utf8_text,
)
from cellspark.operators.ages import with_age, with_species_ages
from workload.registry import query
from workload.tables import files, load, obs, sql, uniform_sql, var

_YEARS = "try_cast(nullif(regexp_extract({c}, '([0-9]+(?:[.][0-9]+)?)-year-old', 1), '') AS DOUBLE)"
_MONTHS = "try_cast(nullif(regexp_extract({c}, '([0-9]+(?:[.][0-9]+)?)[ \\t\\n\\r\\f\\v]*-?[ \\t\\n\\r\\f\\v]*m(?:onth)?', 1), '') AS DOUBLE)"


@query("x1_age_years", sql("SELECT cell_id, development_stage, age FROM aged"))
def age_years(spark, folder):
    return with_age(obs(spark, folder)).select("cell_id", "development_stage", "age")


@query(
    "x1_x2_ages_of_any_text",
    sql(f"""
    , told AS (SELECT conv_id, turn, text || CASE conv_id % 3 WHEN 0 THEN ' a ' || (conv_id % 90) || '-year-old stage'
      WHEN 1 THEN ' a ' || (conv_id % 30) || '-month-old stage' ELSE '' END AS text FROM conversations)
    SELECT conv_id, turn, {_YEARS.format(c="text")} AS years, {_MONTHS.format(c="text")} AS months FROM told"""),
)
def ages_of_any_text(spark, folder):
    """Turns of two conversations in three tell an age, in years or months."""
    conv = F.col("conv_id")
    years = F.concat(F.lit(" a "), (conv % 90).cast("string"), F.lit("-year-old stage"))
    months = F.concat(F.lit(" a "), (conv % 30).cast("string"), F.lit("-month-old stage"))
    text = F.concat("text", F.when(conv % 3 == 0, years).when(conv % 3 == 1, months).otherwise(F.lit("")))
    return load(spark, folder, "conversations").select(
        "conv_id", "turn", age_in_years(text).alias("years"), age_in_months(text).alias("months")
    )


@query("x3_species_ages", sql("SELECT cell_id, organism, age_years, age_months FROM meta"))
def species_ages(spark, folder):
    aged = with_species_ages(obs(spark, folder), "sampling_stage")
    return aged.select("cell_id", "organism", "age_years", "age_months")


@query(
    "x3_species_ages_with_present_values",
    sql(f"""
    SELECT cell_id, coalesce(CASE WHEN disease = 'F' THEN 99.0::DOUBLE END,
        CASE WHEN organism = 'Homo sapiens' THEN {_YEARS.format(c="development_stage")} END) AS age_years,
      coalesce(CASE WHEN organism = 'Mus musculus' THEN {_MONTHS.format(c="development_stage")} END,
        CASE WHEN organism = 'Mus musculus' THEN try_cast(CASE WHEN disease = 'O' THEN '7' ELSE 'adult' END AS DOUBLE) END)
        AS age_months
    FROM obs"""),
)
def species_ages_with_present_values(spark, folder):
    """Present years win; a plain age column is the last choice for months; text that is no number is null."""
    cells = obs(spark, folder).withColumns(
        {
            "age_years": F.when(F.col("disease") == "F", F.lit(99.0)),
            "age": F.when(F.col("disease") == "O", "7").otherwise("adult"),
        }
    )
    return with_species_ages(cells).select("cell_id", "age_years", "age_months")


@query(
    "x3_ages_without_organism",
    sql(f"""
    SELECT cell_id, {_YEARS.format(c="development_stage")} AS age_years,
      {_MONTHS.format(c="development_stage")} AS age_months FROM obs"""),
)
def ages_without_organism(spark, folder):
    return with_species_ages(obs(spark, folder).drop("organism")).select("cell_id", "age_years", "age_months")


@query(
    "x4_x5_symbol_choice",
    sql("""
    SELECT gene_idx, feature_name LIKE 'ENS%' AS is_ensembl,
      CASE WHEN feature_name NOT LIKE 'ENS%' THEN feature_name ELSE ensembl_gene_id END AS name FROM var"""),
)
def symbol_choice(spark, folder):
    feature = F.col("feature_name")
    name = F.when(~is_ensembl_id(feature), feature).otherwise(F.col("ensembl_gene_id"))
    return var(spark, folder).select("gene_idx", is_ensembl_id(feature).alias("is_ensembl"), name.alias("name"))


@query(
    "x6_join_strings",
    sql("""
    SELECT dataset_id, string_agg(part, ', ' ORDER BY part) AS listed FROM (
      SELECT DISTINCT dataset_id, tissue || ' ' || sex AS part FROM obs) GROUP BY 1"""),
)
def join_strings(spark, folder):
    parts = obs(spark, folder).select("dataset_id", F.concat_ws(" ", "tissue", "sex").alias("part")).distinct()
    return parts.groupBy("dataset_id").agg(F.array_join(F.sort_array(F.collect_list("part")), ", ").alias("listed"))


@query(
    "x7_x8_text_checks",
    sql(r"""
    , told AS (SELECT doc_id, text || CASE doc_id % 3 WHEN 0 THEN ' ENSG' || doc_id WHEN 1 THEN ' 31-year-old' ELSE '' END AS text
      FROM documents)
    SELECT doc_id, length(text)::BIGINT AS chars, regexp_matches(text, '\bENS[A-Z]*[0-9]+') AS has_ensembl,
      regexp_matches(text, '[0-9]+-year-old') AS has_age FROM told"""),
)
def text_checks(spark, folder):
    """Two documents in three end in an Ensembl id or an age."""
    doc = F.col("doc_id")
    gene = F.concat(F.lit(" ENSG"), doc.cast("string"))
    text = F.concat("text", F.when(doc % 3 == 0, gene).when(doc % 3 == 1, F.lit(" 31-year-old")).otherwise(F.lit("")))
    return load(spark, folder, "documents").select(
        "doc_id",
        F.length(text).cast("bigint").alias("chars"),
        has_ensembl_token(text).alias("has_ensembl"),
        text.rlike("[0-9]+-year-old").alias("has_age"),
    )


@query(
    "x9_sanitize_names",
    sql(r"""
    SELECT path, trim(regexp_replace(regexp_replace(path, '[^\p{L}\p{N}_\-.]', '_', 'g'), '_+', '_', 'g'), '_') AS name
    FROM files"""),
)
def sanitize_names(spark, folder):
    return files(spark, folder).select("path", sanitize_name(F.col("path")).alias("name"))


@query(
    "x10_organism_key",
    sql("""
    SELECT organism, translate(lower(organism), ' -', '__') AS organism_key, count(*) AS cells FROM obs GROUP BY 1, 2"""),
)
def organism_keys(spark, folder):
    keyed = obs(spark, folder).select("organism", organism_key(F.col("organism")).alias("organism_key"))
    return keyed.groupBy("organism", "organism_key").agg(F.count("*").alias("cells"))


@query(
    "x11_path_stem",
    sql(r"""
    SELECT page_id, regexp_replace(regexp_extract(url, '([^/]+)/?$', 1), '(.)\.[^.]*$', '\1') AS stem,
      replace(regexp_replace(regexp_extract(path, '([^/]+)/?$', 1), '(.)\.[^.]*$', '\1'), '_meta', '') AS dataset_id
    FROM (SELECT page_id, url, '/meta/' || page_id || '_meta_' || md5(url) || '_meta.parquet' AS path FROM pages)"""),
)
def path_stems(spark, folder):
    path = F.concat(F.lit("/meta/"), F.col("page_id"), F.lit("_meta_"), F.md5("url"), F.lit("_meta.parquet"))
    return load(spark, folder, "pages").select(
        "page_id", path_stem(F.col("url")).alias("stem"), dataset_id_from_path(path).alias("dataset_id")
    )


@query(
    "f10_x12_portal_paths",
    sql("""
    , named AS (
      SELECT page_id, url, CASE WHEN url LIKE 'https%' THEN
          'https://x.org/' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
            || substr(h, 17, 4) || '-' || substr(h, 21, 12) || '.h5ad'
        WHEN url LIKE '%/fr/%' THEN 'https://datasets.CellxGene.example/' || page_id || '.h5ad'
        ELSE '/data/' || h || '.h5ad' END AS path
      FROM (SELECT *, md5(url) AS h FROM pages))
    SELECT page_id, path, url LIKE 'https%' AS is_uuid, (url LIKE 'https%' OR url LIKE '%/fr/%') AS is_portal FROM named"""),
)
def portal_paths(spark, folder):
    h = F.md5("url")
    pieces = [F.substring(h, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    by_uuid = F.concat(F.lit("https://x.org/"), F.concat_ws("-", *pieces), F.lit(".h5ad"))
    by_host = F.concat(F.lit("https://datasets.CellxGene.example/"), F.col("page_id"), F.lit(".h5ad"))
    plain = F.concat(F.lit("/data/"), h, F.lit(".h5ad"))
    path = F.when(F.col("url").startswith("https"), by_uuid).when(F.col("url").contains("/fr/"), by_host).otherwise(plain)
    return load(spark, folder, "pages").select(
        "page_id",
        path.alias("path"),
        is_uuid(path_stem(path)).alias("is_uuid"),
        looks_like_portal_path(path).alias("is_portal"),
    )


@query(
    "x13_rounded_ratios",
    sql("""
    SELECT tissue, round(count(age)::DOUBLE * 100 / count(*), 2) AS known_pct, round(avg(age), 2) AS age_mean,
      (1 / 0.05)::INTEGER AS least FROM aged GROUP BY 1"""),
)
def rounded_ratios(spark, folder):
    cells = with_age(obs(spark, folder))
    return cells.groupBy("tissue").agg(
        percent(F.count("age"), F.count("*")).alias("known_pct"),
        F.round(F.avg("age"), 2).alias("age_mean"),
        F.lit(int(1 / 0.05)).alias("least"),
    )


@query("x14_hash_uniform", sql(f"SELECT cell_id, {uniform_sql('cell_id')} AS u FROM obs"))
def hash_uniforms(spark, folder):
    return obs(spark, folder).select("cell_id", hash_uniform(["cell_id"]).alias("u"))


@query(
    "x15_seeded_vector",
    sql(f"""
    SELECT donor_id, {uniform_sql("donor_id", 42)} AS u42, {uniform_sql("donor_id", 43)} AS u43
    FROM (SELECT DISTINCT donor_id FROM obs)"""),
)
def seeded_vector(spark, folder):
    donors = obs(spark, folder).select("donor_id").distinct()
    return donors.select(
        "donor_id", hash_uniform(["donor_id"], 42).alias("u42"), hash_uniform(["donor_id"], 43).alias("u43")
    )


@query(
    "x16_x17_durations_and_sizes",
    sql("""
    SELECT event_id, lpad((s // 3600)::VARCHAR, 2, '0') || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':'
        || lpad((s % 60)::VARCHAR, 2, '0') AS elapsed,
      round(s / 1048576.0::DOUBLE, 6) AS mb, round(s / 1073741824.0::DOUBLE, 9) AS gb
    FROM (SELECT event_id, floor(value * 100)::BIGINT AS s FROM events)"""),
)
def durations_and_sizes(spark, folder):
    seconds = F.floor(F.col("value") * 100)
    return load(spark, folder, "events").select(
        "event_id",
        hms(seconds).alias("elapsed"),
        F.round(megabytes(seconds), 6).alias("mb"),
        F.round(gigabytes(seconds), 9).alias("gb"),
    )


@query(
    "x18_x19_decode_text",
    sql("SELECT doc_id, text AS decoded, n_chars::VARCHAR AS n_chars_text FROM documents"),
)
def decode_text(spark, folder):
    return load(spark, folder, "documents").select(
        "doc_id",
        utf8_text(F.encode("text", "UTF-8")).alias("decoded"),
        F.col("n_chars").cast("string").alias("n_chars_text"),
    )


@query(
    "x20_null_tests",
    sql("""
    SELECT cell_id, assay IS NULL AS no_assay, coalesce(assay, 'nan') AS assay, try_cast(tissue AS DOUBLE) AS number,
      length(tissue)::BIGINT AS size FROM obs"""),
)
def null_tests(spark, folder):
    assay = F.col("assay")
    return obs(spark, folder).select(
        "cell_id",
        assay.isNull().alias("no_assay"),
        F.coalesce(assay, F.lit("nan")).alias("assay"),
        F.col("tissue").try_cast("double").alias("number"),
        F.length("tissue").cast("bigint").alias("size"),
    )


@query(
    "x21_array_functions",
    sql("""
    SELECT vec_id, len(list_filter(embedding, lambda v: v > 0))::BIGINT AS positive,
      list_transform(embedding[1:5], lambda v: round(v::DOUBLE * 2, 4) + 0.0::DOUBLE) AS doubled_head,
      list_contains(list_transform(embedding, lambda v: v > 0.3), true) AS has_large
    FROM embeddings"""),
)
def array_functions(spark, folder):
    return load(spark, folder, "embeddings").select(
        "vec_id",
        F.size(F.filter("embedding", lambda v: v > 0)).cast("bigint").alias("positive"),
        F.transform(F.slice("embedding", 1, 5), lambda v: F.round(v.cast("double") * 2, 4) + 0.0).alias("doubled_head"),
        F.array_contains(F.transform("embedding", lambda v: v > F.lit(0.3).cast("float")), True).alias("has_large"),
    )


@query(
    "p16_truncated_text",
    sql("""
    SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...[truncated]' ELSE text END AS text
    FROM documents"""),
)
def truncated_text(spark, folder):
    return load(spark, folder, "documents").select("doc_id", truncated(F.col("text"), 200).alias("text"))
