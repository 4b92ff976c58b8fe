"""Counts, summaries, profiles, log metrics and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellspark.operators.ages import age_distribution, with_age, with_species_ages
from cellspark.operators.columns import fill_missing_text, share_of_total
from cellspark.operators.genes import gene_list_sizes, map_genes
from cellspark.operators.inventory import inventory_totals, run_report, run_totals, storage_by
from cellspark.operators.profile import QUARTILES, nonzero_columns, nonzero_genes, null_counts, table_profile
from cellspark.operators.runlogs import last_by_message, log_advice, log_metrics, missing_columns
from cellspark.operators.summaries import (
    category_summary,
    dataset_summaries,
    distinct_with_null,
    mask_months,
    top_values,
    value_counts,
)
from cellspark.plans.batch import plan_batch
from cellspark.sources.files import parse_event_log
from workload.registry import query
from workload.tables import files, gene_lists, hgnc, load, obs, outputs, sql, var


def meta(spark, folder):
    """Cells with both age columns, as metadata extraction leaves them."""
    return with_species_ages(obs(spark, folder), "sampling_stage")


@query("a1_row_counts", sql("SELECT dataset_id, count(*) AS cells FROM obs GROUP BY 1"))
def row_counts(spark, folder):
    return obs(spark, folder).groupBy("dataset_id").agg(F.count("*").alias("cells"))


@query("a2_age_distribution", sql("SELECT age, count(*) AS cells FROM sampled GROUP BY 1"))
def ages(spark, folder):
    return age_distribution(with_age(obs(spark, folder), "sampling_stage"))


@query(
    "a3_a4_age_statistics",
    sql("""
    SELECT dataset_id, min(age_years) AS years_min, max(age_years) AS years_max, round(avg(age_years), 2) AS years_mean,
      count(age_years) AS with_years, min(age_months) AS months_min, max(age_months) AS months_max,
      round(avg(age_months), 2) AS months_mean, count(age_months) AS with_months FROM meta GROUP BY 1"""),
)
def age_statistics(spark, folder):
    stats = []
    for unit in ("years", "months"):
        age = f"age_{unit}"
        stats += [
            F.min(age).alias(f"{unit}_min"),
            F.max(age).alias(f"{unit}_max"),
            F.round(F.avg(age), 2).alias(f"{unit}_mean"),
            F.count(age).alias(f"with_{unit}"),
        ]
    return meta(spark, folder).groupBy("dataset_id").agg(*stats)


@query(
    "a5_distinct_with_null",
    sql("""
    SELECT dataset_id, count(DISTINCT assay) + max((assay IS NULL)::INTEGER) AS assays FROM obs GROUP BY 1"""),
)
def distinct_assays(spark, folder):
    return obs(spark, folder).groupBy("dataset_id").agg(distinct_with_null("assay").alias("assays"))


@query(
    "a6_first_known",
    sql("""
    SELECT donor_id, min(dataset_id) AS dataset_id, arg_min(assay, cell_id) FILTER (assay IS NOT NULL) AS first_assay
    FROM obs GROUP BY 1"""),
)
def first_known(spark, folder):
    first = F.min_by("assay", F.when(F.col("assay").isNotNull(), F.col("cell_id")))
    return obs(spark, folder).groupBy("donor_id").agg(
        F.min("dataset_id").alias("dataset_id"), first.alias("first_assay")
    )


@query(
    "a8_group_and_explode",
    sql("SELECT gene_idx, symbol, mapped_via FROM genes"),
)
def group_and_explode(spark, folder):
    """Genes put into lists of at most a hundred by number and taken apart again: the same rows in group order."""
    genes = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])
    rows = F.collect_list(F.struct("gene_idx", "symbol", "mapped_via")).alias("rows")
    return genes.groupBy(F.floor(F.col("gene_idx") / 100).alias("hundred")).agg(rows).select(F.inline("rows"))


_LISTED = """
    SELECT {keys}, '{field}' AS field, count(*) AS "distinct",
      string_agg(value || ': ' || n, ', ' ORDER BY n DESC, value) FILTER (value IS NOT NULL) AS listed
    FROM (SELECT {keys}, {field} AS value, count(*) AS n FROM {source} GROUP BY ALL) GROUP BY {keys}"""


@query(
    "a9_category_summary",
    sql(
        " UNION ALL ".join(
            _LISTED.format(keys="dataset_id", field=f, source="obs") for f in ("tissue", "cell_type", "assay", "sex")
        )
    ),
)
def categories(spark, folder):
    return category_summary(obs(spark, folder), ["tissue", "cell_type", "assay", "sex"], ["dataset_id"])


@query(
    "a10_age_lists",
    sql("""
    SELECT dataset_id, 'age_years' AS field, count(*) AS "distinct",
      string_agg(age_years || ': ' || n, ', ' ORDER BY age_years) FILTER (age_years IS NOT NULL) AS listed
    FROM (SELECT dataset_id, age_years, count(*) AS n FROM meta GROUP BY ALL) GROUP BY 1
    UNION ALL
    SELECT dataset_id, 'age_months', count(*),
      string_agg(age_months || ': ' || n, ', ' ORDER BY age_months) FILTER (age_months IS NOT NULL)
    FROM (SELECT dataset_id, age_months, count(*) AS n FROM meta GROUP BY ALL) GROUP BY 1"""),
)
def age_lists(spark, folder):
    return category_summary(meta(spark, folder), ["age_years", "age_months"], ["dataset_id"])


def _list_of(field: str, source: str = "filled") -> str:
    return f"""(SELECT dataset_id, count(*) AS n_values,
      string_agg(value || ': ' || n, ', ' ORDER BY n DESC, value) FILTER (value IS NOT NULL) AS listed
      FROM (SELECT dataset_id, {field} AS value, count(*) AS n FROM {source} GROUP BY ALL) GROUP BY 1)"""


def _ages_of(unit: str) -> str:
    return f"""(SELECT dataset_id, string_agg(age || ': ' || n, ', ' ORDER BY age) AS listed
      FROM (SELECT dataset_id, age_{unit} AS age, count(*) AS n FROM filled WHERE age_{unit} IS NOT NULL GROUP BY ALL)
      GROUP BY 1)"""


SUMMARY_SQL = f"""
    , filled AS (SELECT * REPLACE (coalesce(assay, 'nan') AS assay) FROM meta)
    , base AS (
      SELECT dataset_id, count(*) AS total_cells, min(organism) AS organism, count(DISTINCT donor_id) AS unique_donors,
        min(age_years) AS age_years_min, max(age_years) AS age_years_max, round(avg(age_years), 2) AS age_years_mean,
        count(age_years) AS cells_with_age_years, min(age_months) AS months_min, max(age_months) AS months_max,
        round(avg(age_months), 2) AS months_mean, count(age_months) AS with_months
      FROM filled GROUP BY 1)
    , summary AS (
      SELECT b.dataset_id, total_cells, organism, unique_donors, age_years_min, age_years_max, age_years_mean,
        cells_with_age_years,
        CASE WHEN organism = 'Mus musculus' THEN months_min END AS age_months_min,
        CASE WHEN organism = 'Mus musculus' THEN months_max END AS age_months_max,
        CASE WHEN organism = 'Mus musculus' THEN months_mean END AS age_months_mean,
        CASE WHEN organism = 'Mus musculus' THEN with_months END AS cells_with_age_months,
        t.n_values AS unique_tissues, t.listed AS tissues, c.n_values AS unique_cell_types, c.listed AS cell_types,
        a.n_values AS unique_assays, a.listed AS assays, s.n_values AS unique_sexes, s.listed AS sexes,
        d.n_values AS unique_diseases, d.listed AS diseases, y.listed AS unique_ages_years,
        CASE WHEN organism = 'Mus musculus' THEN m.listed END AS unique_ages_months
      FROM base b LEFT JOIN {_list_of("tissue")} t ON b.dataset_id = t.dataset_id
      LEFT JOIN {_list_of("cell_type")} c ON b.dataset_id = c.dataset_id
      LEFT JOIN {_list_of("assay")} a ON b.dataset_id = a.dataset_id
      LEFT JOIN {_list_of("sex")} s ON b.dataset_id = s.dataset_id
      LEFT JOIN {_list_of("disease")} d ON b.dataset_id = d.dataset_id
      LEFT JOIN {_ages_of("years")} y ON b.dataset_id = y.dataset_id
      LEFT JOIN {_ages_of("months")} m ON b.dataset_id = m.dataset_id)"""


@query("a11_dataset_summary", sql(f"{SUMMARY_SQL} SELECT * FROM summary"))
def dataset_summary(spark, folder):
    return dataset_summaries(fill_missing_text(meta(spark, folder)))


@query(
    "a12_mask_months",
    sql("""
    SELECT organism, count(*) AS cells, CASE WHEN organism = 'Mus musculus' THEN min(age) END AS age_months_min,
      CASE WHEN organism = 'Mus musculus' THEN count(age) END AS cells_with_age_months FROM aged GROUP BY 1"""),
)
def masked_months(spark, folder):
    stats = with_age(obs(spark, folder)).groupBy("organism").agg(
        F.count("*").alias("cells"),
        F.min("age").alias("age_months_min"),
        F.count("age").alias("cells_with_age_months"),
    )
    return mask_months(stats)


LOG_MESSAGES = {
    "error": "warning_missing_column",
    "view": "gene_mapping_summary",
    "purchase": "age_extraction_summary",
    "signup": "filtering_summary",
    "click": "sample_null_age_development_stages",
}


def log_lines(spark, folder):
    """The event table as a JSON-lines log: the event type gives the message, ``props`` its figures."""
    events = load(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    message = F.col("event_type")
    for event, name in LOG_MESSAGES.items():
        message = F.when(F.col("event_type") == event, name).otherwise(message)
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    fields = F.struct(
        message.alias("message_type"),
        seconds.alias("timestamp"),
        F.concat(F.lit("column_"), k.cast("string")).alias("column"),
        (k * 100).alias("total_cells"),
        (k * 90).alias("cells_with_valid_age"),
        (k * 10).alias("cells_with_null_age"),
        (k + 1000).alias("total_genes"),
        (k + 900).alias("mapped_via_hgnc"),
        F.lit(40).alias("mapped_via_fallback"),
        F.lit(60).alias("unmapped_using_ensembl_id"),
        k.alias("cells_discarded"),
        F.array(F.struct(F.concat(F.lit("stage "), k.cast("string")).alias("development_stage"))).alias("samples"),
    )
    return events.select(F.to_json(fields).alias("value"))


_LAST_K = "arg_max((props->>'$.k')::BIGINT, ts) FILTER (event_type = '{event}')"


@query(
    "a22_log_metrics",
    f"""
    WITH k AS (SELECT {_LAST_K.format(event="view")} AS genes, {_LAST_K.format(event="purchase")} AS cells,
        {_LAST_K.format(event="signup")} AS lost, {_LAST_K.format(event="click")} AS sample,
        list_sort(list('column_' || (props->>'$.k')) FILTER (event_type = 'error')) AS missing FROM events)
    SELECT cells * 100 AS total_cells, cells * 90 AS cells_with_valid_age, cells * 10 AS cells_with_null_age,
      genes + 1000 AS genes_total, genes + 900 AS genes_mapped_hgnc, 40::BIGINT AS genes_mapped_fallback,
      60::BIGINT AS genes_unmapped, lost AS cells_discarded_in_split, missing AS missing_columns,
      ['stage ' || sample] AS sample_null_ages,
      round(cells * 10 / greatest(cells * 100, 1)::DOUBLE, 4) AS null_age_share,
      round(60 / greatest(genes + 1000, 1)::DOUBLE, 4) AS unmapped_share,
      cells * 10 / greatest(cells * 100, 1)::DOUBLE > 0.1 AS too_many_null_ages,
      60 / greatest(genes + 1000, 1)::DOUBLE > 0.05 AS too_many_unmapped_genes
    FROM k""",
)
def metrics(spark, folder):
    return log_advice(log_metrics(parse_event_log(log_lines(spark, folder))))


@query(
    "a22_missing_columns",
    """SELECT 'column_' || (props->>'$.k') AS "column", count(*) AS events FROM events WHERE event_type = 'error'
    GROUP BY 1""",
)
def missing_column_counts(spark, folder):
    return missing_columns(parse_event_log(log_lines(spark, folder)))


@query(
    "a22_last_value_per_message",
    """SELECT event_type, count(*) AS events, arg_max(value, ts) AS last_value, max(ts) AS last_time
    FROM events GROUP BY 1""",
)
def last_value_per_message(spark, folder):
    return last_by_message(load(spark, folder, "events"), "event_type", "value", "ts")


@query(
    "a23_null_counts",
    sql("""
    SELECT count(*) - count(cell_id) AS cell_id, count(*) - count(assay) AS assay, count(*) - count(age_years) AS age_years,
      count(*) - count(age_months) AS age_months, count(*) - count(tissue) AS tissue FROM meta"""),
)
def nulls(spark, folder):
    return null_counts(meta(spark, folder).select("cell_id", "assay", "age_years", "age_months", "tissue"))


def _profile_sql(columns: list[tuple[str, str, bool]]) -> str:
    rows = []
    for name, dtype, number in columns:
        if number:
            quartiles = ", ".join(f"quantile_disc({name}, {q})::DOUBLE AS {n}" for n, q in QUARTILES.items())
            stats = (
                f"min({name})::DOUBLE AS min_value, max({name})::DOUBLE AS max_value, round(avg({name}), 2) AS mean_value, "
                f"round(stddev_samp({name}), 2) AS std_value, {quartiles}"
            )
        else:
            stats = ", ".join(f"NULL::DOUBLE AS {n}" for n in ("min_value", "max_value", "mean_value", "std_value", *QUARTILES))
        rows.append(
            f"SELECT '{name}' AS column_name, '{dtype}' AS column_type, count(*) AS total_rows, "
            f"count({name}) AS non_null, {stats} FROM lineitem"
        )
    return " UNION ALL ".join(rows)


@query(
    "a24_table_profile",
    _profile_sql([("l_linenumber", "int", True), ("l_quantity", "double", True), ("l_returnflag", "string", False)]),
)
def profile(spark, folder):
    return table_profile(load(spark, folder, "lineitem").select("l_linenumber", "l_quantity", "l_returnflag"))


@query(
    "a25_top_values",
    sql("SELECT donor_id, count(*) AS cells FROM obs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
)
def top_donors(spark, folder):
    return top_values(obs(spark, folder), "donor_id")


@query(
    "a26_nonzero_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (count(*) FILTER ({c} <> 0))::BIGINT AS nonzero, "
        f"round((count(*) FILTER ({c} <> 0))::DOUBLE * 100 / count(*), 2) AS nonzero_pct FROM lineitem"
        for c in ("l_discount", "l_tax", "l_quantity")
    ),
)
def nonzero(spark, folder):
    return nonzero_columns(load(spark, folder, "lineitem"), ["l_discount", "l_tax", "l_quantity"])


@query(
    "a26_nonzero_genes",
    """SELECT vec_id, len(embedding)::INTEGER AS genes, len(list_filter(embedding, lambda v: abs(v) >= 0.0625))::INTEGER AS nonzero,
      round(len(list_filter(embedding, lambda v: abs(v) >= 0.0625))::DOUBLE * 100 / len(embedding), 2) AS nonzero_pct
    FROM embeddings""",
)
def nonzero_by_cell(spark, folder):
    """Small values of the vectors are set to zero first, so that there are zeros."""
    cut = F.transform("embedding", lambda v: F.when(F.abs(v) >= 0.0625, v).otherwise(F.lit(0.0)))
    return nonzero_genes(load(spark, folder, "embeddings").withColumn("embedding", cut), ["vec_id"], "embedding")


@query(
    "a27_storage_by_split",
    sql("""
    SELECT split, count(*) AS files, sum(length)::BIGINT AS bytes, round(sum(length) / 1048576.0::DOUBLE, 2) AS mb,
      round(sum(length) / 1073741824.0::DOUBLE, 4) AS gb FROM outputs GROUP BY 1"""),
)
def storage_by_split(spark, folder):
    return storage_by(outputs(spark, folder), "split")


@query(
    "a27_inventory_totals",
    sql("""
    SELECT count(*) AS files, sum(length)::BIGINT AS total_bytes, round(sum(length) / 1048576.0::DOUBLE, 2) AS total_mb
    FROM files"""),
)
def file_totals(spark, folder):
    return inventory_totals(files(spark, folder))


def run_results(spark, folder):
    """One job per event: errors failed, sign-ups were skipped, ``value`` is its run time in minutes."""
    kind = F.col("event_type")
    status = F.when(kind == "error", "FAILED").when(kind == "signup", "SKIPPED").otherwise("SUCCESS")
    message = F.when(kind == "error", F.col("props")).when(kind == "signup", "Output files already exist").otherwise("ok")
    return load(spark, folder, "events").select(
        F.concat(F.lit("ds_"), F.col("event_id").cast("string")).alias("dataset_name"),
        status.alias("status"),
        (F.floor(F.col("value") * 100) / 2).alias("seconds"),
        F.concat(F.lit("/out/ds_"), F.col("event_id").cast("string")).alias("output_path"),
        message.alias("message"),
    )


@query(
    "a28_run_report",
    """
    WITH r AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' ELSE 'SUCCESS' END
        AS status, CASE WHEN event_type = 'signup' THEN 0 ELSE floor(value * 100) / 2 END AS seconds, event_type, props
      FROM events), t AS (SELECT *, floor(seconds)::BIGINT AS s FROM r)
    SELECT 'ds_' || event_id AS dataset_name, status, round(seconds, 2)::DOUBLE AS processing_time_seconds,
      lpad((s // 3600)::VARCHAR, 2, '0') || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':'
        || lpad((s % 60)::VARCHAR, 2, '0') AS processing_time_formatted,
      '/out/ds_' || event_id AS output_path,
      CASE event_type WHEN 'error' THEN 'CRASH: ' || props WHEN 'signup' THEN 'Output files already exist' ELSE 'ok' END
        AS message FROM t""",
)
def report(spark, folder):
    return run_report(run_results(spark, folder))


@query(
    "a28_run_totals",
    """SELECT count(*) AS total, (count(*) FILTER (event_type NOT IN ('error', 'signup')))::BIGINT AS successful,
      (count(*) FILTER (event_type = 'error'))::BIGINT AS failed, (count(*) FILTER (event_type = 'signup'))::BIGINT AS skipped
    FROM events""",
)
def report_totals(spark, folder):
    return run_totals(run_results(spark, folder))


@query(
    "a29_gene_list_sizes",
    sql("SELECT list_name, count(DISTINCT symbol) AS genes FROM gene_lists GROUP BY 1"),
)
def list_sizes(spark, folder):
    genes = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])
    return gene_list_sizes(gene_lists(spark, folder, genes))


@query(
    "a18_share_of_total",
    sql("""
    SELECT tissue, count(*) AS cells, round(count(*)::DOUBLE * 100 / sum(count(*)) OVER (), 2) AS pct FROM obs GROUP BY 1"""),
)
def tissue_shares(spark, folder):
    return share_of_total(value_counts(obs(spark, folder), "tissue"), "cells", "pct")


@query(
    "c7_batch_plan",
    sql(r"""
    , planned AS (
      SELECT lang || '_set_' || doc_id AS dataset_name, path, length,
        CASE WHEN length / 1048576.0 > 0.005
               THEN printf('skipped (file too large: %.2f MB > 0.005 MB)', length / 1048576.0::DOUBLE)
             WHEN lang || '_set_' || doc_id IN (SELECT split_part(path, '/', 3) FROM outputs)
             THEN 'Output files already exist' END AS message FROM files)
    SELECT *, CASE WHEN message IS NULL THEN 'run' ELSE 'skip' END AS action FROM planned"""),
)
def batch_plan(spark, folder):
    planned = plan_batch(files(spark, folder), outputs(spark, folder), 0.005)
    return planned.select("dataset_name", "path", "length", "message", "action")
