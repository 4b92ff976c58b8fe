"""Sentences, dataset builds, metadata extraction, species summary, incremental ingest."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cellspark.operators.ages import with_age, with_known_age
from cellspark.operators.columns import fill_missing_text
from cellspark.operators.genes import flag_lists, map_genes
from cellspark.operators.sentences import (
    sentences_from_arrays,
    sentences_from_long,
    to_sparse,
    top_sentences,
)
from cellspark.operators.summaries import species_summary
from cellspark.plans.batch import batch_report, pending_rows, plan_batch
from cellspark.plans.build import BuildOptions, build_dataset, convert_dataset
from cellspark.plans.isolation import broken_datasets, check_files, dataset_of_partition, sound_rows
from cellspark.plans.metadata import extract_metadata, resplit_dataset
from cellspark.session import materialize, scratch_path
from cellspark.sinks.parquet import write_all_splits, write_by_cell
from cellspark.sources.files import list_files
from cellspark.streaming.ingest import ingest_new_files, read_ingested
from cellspark.streaming.quotas import ARRIVAL, ingest_with_quotas
from workload.aggregates import SUMMARY_SQL, meta
from workload.registry import query
from workload.sorts import symbol_expr
from workload.splits import _quota_sql, aged
from workload.tables import (
    collections,
    donor_expr,
    expr,
    gene_lists,
    hgnc,
    load,
    obs,
    panel_columns,
    panel_expr,
    sql,
    uniform_sql,
    var,
)

LISTS = ["small", "brand1"]


def _genes(spark, folder):
    """Mapped genes with their list membership."""
    genes = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"]).select("gene_idx", "symbol")
    return flag_lists(genes, gene_lists(spark, folder, genes), LISTS)


def _sentences_sql(source: str, top_n: int = 10) -> str:
    """All sentence variants over rows (cell_id, gene_idx, value) of ``source``."""
    word = "string_agg(symbol, ' ' ORDER BY value DESC, gene_idx DESC)"
    return f"""
    , words AS (
      SELECT cell_id, s.gene_idx, symbol, value, symbol NOT LIKE 'ENS%' AS usable,
        symbol IN (SELECT symbol FROM gene_lists WHERE list_name = 'small') AS in_small,
        symbol IN (SELECT symbol FROM gene_lists WHERE list_name = 'brand1') AS in_brand1,
        row_number() OVER (PARTITION BY cell_id ORDER BY symbol LIKE 'ENS%', value DESC, s.gene_idx DESC) AS rank
      FROM {source} s JOIN genes g ON s.gene_idx = g.gene_idx)
    , sentences AS (
      SELECT cell_id, coalesce({word} FILTER (usable), '') AS gene_sentence_all,
        coalesce({word} FILTER (usable AND rank <= {top_n}), '') AS gene_sentence_{top_n},
        coalesce({word} FILTER (usable AND in_small), '') AS gene_sentence_small,
        coalesce({word} FILTER (usable AND in_brand1), '') AS gene_sentence_brand1
      FROM words GROUP BY 1)"""


@query("c1_cell_sentence_topn", sql(f"{_sentences_sql('expr')} SELECT cell_id, gene_sentence_10 FROM sentences"))
def cell_sentence_topn(spark, folder):
    """Top-10 sentence of every order."""
    return top_sentences(symbol_expr(spark, folder), ["cell_id"], 10)


@query("c1_cell_sentence_variants", sql(f"{_sentences_sql('donor_expr')} SELECT * FROM sentences"))
def cell_sentence_variants(spark, folder):
    """All, top-10 and per-list sentences of every customer, from long form."""
    whole = F.when(F.col("gene_idx").isNotNull(), "all").alias("dataset_id")
    rows, genes = donor_expr(spark, folder).select(whole, "*"), _genes(spark, folder).select(whole, "*")
    return sentences_from_long(rows, genes, ["cell_id"], 10, LISTS).drop("dataset_id")


PANEL_CELL = ["dataset_id", "cell_id"]


def _panel_genes(spark, folder):
    return _genes(spark, folder).withColumns(panel_columns(F.col("gene_idx")))


def _placed_sql(source: str) -> str:
    """Sentences by dataset and cell; the gene index orders as the position in the dataset does."""
    keyed = f"(SELECT dataset_id || ' ' || cell_id AS cell_id, gene_idx, value FROM {source})"
    return f"""{_sentences_sql(keyed)}
    , placed AS (
      SELECT * EXCLUDE (cell_id), split_part(cell_id, ' ', 1) AS dataset_id,
        split_part(cell_id, ' ', 2)::BIGINT AS cell_id
      FROM sentences)"""


@query("c1_cell_sentence_sparse", sql(f"{_placed_sql('panel_expr')} SELECT * FROM placed"))
def cell_sentence_sparse(spark, folder):
    """All variants of every order in every dataset from array form, stored values only."""
    cells = to_sparse(panel_expr(spark, folder, "l_orderkey"), PANEL_CELL)
    genes = _panel_genes(spark, folder)
    return sentences_from_arrays(cells, genes, PANEL_CELL, 10, LISTS, include_zeros=False)


def _both_forms(rows, genes):
    """Sentences of the same cells from long and from array form."""
    from_long = sentences_from_long(rows, genes, PANEL_CELL, 10, LISTS).withColumn("form", F.lit("long"))
    cells = to_sparse(rows, PANEL_CELL)
    from_arrays = sentences_from_arrays(cells, genes, PANEL_CELL, 10, LISTS, include_zeros=False)
    return from_long.unionByName(from_arrays.withColumn("form", F.lit("array")))


def _both_forms_sql(rows: str) -> str:
    """``rows`` is what counts of panel_expr; a cell without any has empty sentences."""
    columns = ", ".join(f"coalesce({n}, '') AS {n}" for n in ("gene_sentence_all", "gene_sentence_10", *(f"gene_sentence_{n}" for n in LISTS)))
    return f"""
    , counted AS ({rows}) {_placed_sql("counted")}
    SELECT c.dataset_id, c.cell_id, form, {columns}
    FROM (SELECT DISTINCT dataset_id, cell_id FROM panel_expr) c CROSS JOIN (VALUES ('long'), ('array')) f(form)
    LEFT JOIN placed p ON c.dataset_id = p.dataset_id AND c.cell_id = p.cell_id"""


@query(
    "c1_zeros_and_nulls",
    sql(_both_forms_sql("SELECT * FROM panel_expr WHERE (gene_idx % 1000) % 5 <> 0 AND (gene_idx % 1000) % 7 <> 0")),
)
def zeros_and_nulls(spark, folder):
    """Stored zeros and nulls do not count where only values do, in either form."""
    place = F.col("gene_idx")
    value = F.when(place % 5 == 0, 0.0).when(place % 7 != 0, F.col("value"))
    return _both_forms(panel_expr(spark, folder, "l_orderkey").withColumn("value", value), _panel_genes(spark, folder))


@query("c1_gene_gaps", sql(_both_forms_sql("SELECT * FROM panel_expr WHERE (gene_idx % 1000) % 3 <> 1")))
def gene_gaps(spark, folder):
    """A third of the gene numbers has no gene, in either form."""
    genes = _panel_genes(spark, folder).filter(F.col("gene_idx") % 3 != 1)
    return _both_forms(panel_expr(spark, folder, "l_orderkey"), genes)


@query(
    "c1_cell_sentence_zero_filled",
    sql(f"""
    , filled AS (
      SELECT c.dataset_id, c.cell_id, p_partkey AS gene_idx, coalesce(value, 0.0::DOUBLE) AS value
      FROM (SELECT DISTINCT dataset_id, cell_id FROM panel_supplier_expr) c
      JOIN part ON dataset_id = 'block_' || (p_partkey // 1000)
      LEFT JOIN supplier_expr e ON e.cell_id = c.cell_id AND e.gene_idx = p_partkey)
    {_placed_sql("filled")} SELECT * FROM placed"""),
)
def cell_sentence_zero_filled(spark, folder):
    """All variants of every supplier in every dataset, genes without a value ranked as zeros."""
    cells = to_sparse(panel_expr(spark, folder, "l_suppkey"), PANEL_CELL)
    return sentences_from_arrays(cells, _panel_genes(spark, folder), PANEL_CELL, 10, LISTS)


@query(
    "c1_cell_sentence_dense",
    sql(f"""
    , filled AS (SELECT 'label_' || label AS dataset_id, vec_id AS cell_id, i AS gene_idx, embedding[i + 1]::DOUBLE AS value
                 FROM embeddings, range(0, len(embedding)) AS r(i))
    {_placed_sql("filled")} SELECT * FROM placed"""),
)
def cell_sentence_dense(spark, folder):
    """All variants of every vector; its label is the dataset, its positions are the genes."""
    cells = load(spark, folder, "embeddings").select(
        F.concat(F.lit("label_"), F.col("label")).alias("dataset_id"),
        F.col("vec_id").alias("cell_id"),
        F.col("embedding").cast("array<double>").alias("expression"),
    )
    position = F.explode(F.sequence(F.lit(0).cast("bigint"), F.size("expression") - 1)).alias("gene_idx")
    measured = cells.select("dataset_id", position).distinct()
    genes = measured.join(_genes(spark, folder), "gene_idx")
    return sentences_from_arrays(cells, genes, PANEL_CELL, 10, LISTS)


OPTIONS = BuildOptions(top_n=10, list_names=tuple(LISTS), include_zeros=False, symbol_order=("rank",))


def dataset_tables(spark, folder):
    """Cells, per-dataset genes and expression keyed by dataset and cell; expression is dealt by cell, as it meets its cells."""
    cells = obs(spark, folder)
    rows = expr(spark, folder, by=("cell_id",)).join(cells.select("dataset_id", "cell_id"), "cell_id")
    measured = rows.select("dataset_id", "gene_idx").distinct()
    genes = measured.join(var(spark, folder), "gene_idx")
    return cells, genes, rows


_BUILT = """cell_id, coalesce(gene_sentence_all, '') AS gene_sentence_all,
      coalesce(gene_sentence_10, '') AS gene_sentence_10, coalesce(gene_sentence_small, '') AS gene_sentence_small,
      coalesce(gene_sentence_brand1, '') AS gene_sentence_brand1"""
_SENTENCES = [f"gene_sentence_{n}" for n in ("all", "10", *LISTS)]


@query(
    "c2_build_dataset",
    sql(f"""
    {_quota_sql("aged", 0.05)} {_sentences_sql("expr")}
    SELECT a.{_BUILT}, a.dataset_id, a.donor_id, age, coalesce(assay, 'nan') AS assay,
      coalesce(collection_id, 'nan') AS collection_id, coalesce(title, 'nan') AS publication_title, split
    FROM aged a JOIN donor_split d ON a.donor_id = d.donor_id LEFT JOIN collections c ON a.dataset_id = c.dataset_id
    LEFT JOIN sentences s ON a.cell_id = s.cell_id WHERE age IS NOT NULL"""),
)
def built_dataset(spark, folder):
    """Sentences, age, publications and donor split of all datasets in one plan."""
    cells, genes, rows = dataset_tables(spark, folder)
    mapped = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])
    built = build_dataset(
        cells,
        genes,
        rows,
        hgnc(spark, folder),
        collections(spark, folder),
        gene_lists(spark, folder, mapped),
        OPTIONS,
    )
    kept = ["cell_id", "dataset_id", "donor_id", "age", "assay", "collection_id", "publication_title", "split"]
    return built.select(*kept, *_SENTENCES)


@query(
    "c2_build_from_one_table",
    sql(f"""
    {_placed_sql("panel_expr")}
    SELECT p.*, donor_id, age, CASE WHEN {uniform_sql("donor_id")} < 0.05 THEN 'test' ELSE 'train' END AS split
    FROM placed p JOIN aged a ON p.cell_id = a.cell_id WHERE age IS NOT NULL"""),
)
def build_from_one_table(spark, folder):
    """Arrays beside the metadata: orders by dataset of a thousand parts; split by donor hash."""
    arrays = to_sparse(panel_expr(spark, folder, "l_orderkey"), PANEL_CELL)
    cells = arrays.join(obs(spark, folder).drop("dataset_id"), "cell_id")
    mapped = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])
    genes = var(spark, folder).withColumns(panel_columns(F.col("gene_idx")))
    options = replace(OPTIONS, stratify_by_age=False)
    built = build_dataset(
        cells, genes, None, hgnc(spark, folder), None, gene_lists(spark, folder, mapped), options
    )
    return built.select("dataset_id", "cell_id", "donor_id", "age", "split", *_SENTENCES)


@query(
    "c2_two_collections",
    sql(f"""
    , more AS (SELECT dataset_id, collection_id, title FROM collections UNION ALL
      SELECT dataset_id, 'again', 'second' FROM collections WHERE title <> 'EUROPE')
    {_sentences_sql("expr")}
    SELECT form, a.{_BUILT}, a.dataset_id, coalesce(collection_id, 'nan') AS collection_id,
      CASE WHEN {uniform_sql("donor_id")} < 0.05 THEN 'test' ELSE 'train' END AS split
    FROM aged a CROSS JOIN (VALUES ('long'), ('array')) f(form) LEFT JOIN more c ON a.dataset_id = c.dataset_id
    LEFT JOIN sentences s ON a.cell_id = s.cell_id WHERE age IS NOT NULL"""),
)
def two_collections(spark, folder):
    """Cells of a dataset in two collections come twice, each with its own sentence, from either form."""
    cells, genes, rows = dataset_tables(spark, folder)
    # Both forms are built from the same rows: they are stored, as deriving them takes longer than reading them.
    rows = materialize(spark, rows, "expression")
    genes = materialize(spark, rows.select("dataset_id", "gene_idx").distinct().join(var(spark, folder), "gene_idx"), "measured-genes")
    mapped = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])
    known = collections(spark, folder)
    second = {"collection_id": F.lit("again"), "title": F.lit("second")}
    both = known.unionByName(known.filter("title <> 'EUROPE'").withColumns(second))
    tables = (hgnc(spark, folder), both, gene_lists(spark, folder, mapped), replace(OPTIONS, stratify_by_age=False))
    kept = ["cell_id", "dataset_id", "collection_id", "split", *_SENTENCES]
    from_long = build_dataset(cells, genes, rows, *tables).select(F.lit("long").alias("form"), *kept)
    from_arrays = build_dataset(cells, genes, to_sparse(rows, PANEL_CELL), *tables).select(F.lit("array").alias("form"), *kept)
    return from_long.unionByName(from_arrays)


_BATCH_SQL = f"""
    , inputs AS (
      SELECT dataset_id, count(*) * 104857600 // (SELECT count(*) FROM obs) AS length FROM obs GROUP BY 1
      UNION ALL SELECT 'broken', 1024)
    , planned AS (
      SELECT dataset_id, CASE
        WHEN length / 1048576.0 > 4.1 THEN printf('skipped (file too large: %.2f MB > 4.1 MB)', length / 1048576.0::DOUBLE)
        WHEN dataset_id IN (SELECT dataset_id FROM collections WHERE title = 'EUROPE') THEN 'Output files already exist'
        END AS message FROM inputs)
    , pending AS (SELECT * FROM aged WHERE dataset_id IN (SELECT dataset_id FROM planned WHERE message IS NULL))
    {_quota_sql("pending", 0.05)}
    , built AS (
      SELECT dataset_id, count(*) AS cells FROM pending p JOIN donor_split d ON p.donor_id = d.donor_id
      WHERE age IS NOT NULL GROUP BY 1)"""


def _batch(spark, folder):
    """Inputs, their plan, and the folder with what was built of them; one input has no rows anywhere."""
    cells, genes, rows = dataset_tables(spark, folder)
    total = cells.agg(F.count("*").alias("n")).select("n").scalar()
    sizes = cells.groupBy("dataset_id").agg(F.count("*").alias("n"))
    length = F.floor(F.col("n") * 104857600 / total).alias("length")  # 100 MB over all datasets
    inputs = sizes.select(F.concat(F.lit("/in/"), "dataset_id", F.lit(".h5ad")).alias("path"), length)
    inputs = inputs.unionByName(spark.createDataFrame([("/in/broken.h5ad", 1024)], "path string, length bigint"))
    finished = collections(spark, folder).filter(F.col("title") == "EUROPE")
    written = finished.select(F.concat(F.lit("/out/"), "dataset_id", F.lit("/train/chunk_0000.parquet")).alias("path"))
    planned = plan_batch(inputs, written, 4.1)
    tables = [pending_rows(table, planned) for table in (cells, genes, rows)]
    path = scratch_path(spark, "batch")
    write_all_splits(build_dataset(*tables, hgnc(spark, folder), options=BuildOptions(top_n=10, include_zeros=False)), path)
    return inputs, planned, path


@query(
    "c7_batch_rerun",
    sql(f"""
    {_BATCH_SQL}
    SELECT p.dataset_id AS dataset_name, CASE WHEN b.dataset_id IS NULL THEN 'run' ELSE 'skip' END AS action,
      CASE WHEN b.dataset_id IS NOT NULL THEN 'Output files already exist' END AS message
    FROM planned p LEFT JOIN built b ON p.dataset_id = b.dataset_id"""),
)
def batch_rerun(spark, folder):
    """Planned again over the files that the first run really wrote: what is there is skipped."""
    inputs, _, path = _batch(spark, folder)
    return plan_batch(inputs, list_files(spark, path, "*.parquet")).select("dataset_name", "action", "message")


@query(
    "c7_batch_build",
    sql(f"""
    {_BATCH_SQL}
    SELECT p.dataset_id AS dataset_name,
      CASE WHEN message IS NOT NULL THEN 'SKIPPED' WHEN b.dataset_id IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status,
      coalesce(cells, 0) AS cells,
      coalesce(message, CASE WHEN b.dataset_id IS NULL THEN 'No rows were built' ELSE 'Successfully processed' END) AS message
    FROM planned p LEFT JOIN built b ON p.dataset_id = b.dataset_id"""),
)
def batch_build(spark, folder):
    """All datasets that are neither too large nor finished, built in one job and written by side."""
    _, planned, path = _batch(spark, folder)
    return batch_report(planned, spark.read.parquet(path))


@query(
    "c3_convert_dataset",
    sql(f"""
    {_sentences_sql("expr")}
    SELECT o.{_BUILT}, dataset_id, coalesce(assay, 'nan') AS assay
    FROM obs o LEFT JOIN sentences s ON o.cell_id = s.cell_id"""),
)
def converted_dataset(spark, folder):
    cells, genes, rows = dataset_tables(spark, folder)
    mapped = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])
    lists = gene_lists(spark, folder, mapped)
    built = convert_dataset(cells, genes, rows, hgnc(spark, folder), lists, OPTIONS)
    return built.select("cell_id", "dataset_id", "assay", *_SENTENCES)


@query(
    "c4_resplit_dataset",
    sql(f"""
    {_quota_sql("aged", 0.1)}
    SELECT cell_id, a.donor_id, age, split FROM aged a JOIN donor_split d ON a.donor_id = d.donor_id
    WHERE age IS NOT NULL"""),
)
def resplit(spark, folder):
    result = resplit_dataset(aged(spark, folder), ["cell_id"], test_size=0.1)
    return result.cells.select("cell_id", "donor_id", "age", "split")


@query(
    "c4_resplit_statistics",
    sql(f"""
    {_quota_sql("aged", 0.1)}
    SELECT split, age, count(*) AS cells FROM aged a JOIN donor_split d ON a.donor_id = d.donor_id
    WHERE age IS NOT NULL GROUP BY 1, 2"""),
)
def resplit_statistics(spark, folder):
    return resplit_dataset(aged(spark, folder), ["cell_id"], test_size=0.1).ages_by_side


@query(
    "c5_extract_metadata",
    sql("""
    SELECT m.cell_id, m.dataset_id, organism, sampling_stage, coalesce(assay, 'nan') AS assay, age_years, age_months, collection_id,
      title AS publication_title, doi AS publication_doi, description AS publication_description,
      contact_name AS publication_contact_name, contact_email AS publication_contact_email
    FROM meta m LEFT JOIN collections c ON m.dataset_id = c.dataset_id"""),
)
def extracted_metadata(spark, folder):
    return extract_metadata(
        obs(spark, folder),
        ["cell_id", "dataset_id", "organism", "sampling_stage", "assay", "not_there"],
        collections=collections(spark, folder),
        age_source="sampling_stage",
    )


@query(
    "c6_species_summary",
    sql(f"""
    {SUMMARY_SQL}
    SELECT s.*, collection_id, title AS publication_title, doi AS publication_doi,
      description AS publication_description, contact_name AS publication_contact_name,
      contact_email AS publication_contact_email
    FROM summary s LEFT JOIN collections c ON s.dataset_id = c.dataset_id"""),
)
def all_species(spark, folder):
    return species_summary(fill_missing_text(meta(spark, folder)), collections(spark, folder))


@query(
    "st1_incremental_ingest",
    sql(f"""
    SELECT files_per_batch, cell_id, donor_id, age,
      CASE WHEN {uniform_sql("donor_id")} < 0.05 THEN 'test' ELSE 'train' END AS split
    FROM aged CROSS JOIN (VALUES (1), (1000)) f(files_per_batch) WHERE age IS NOT NULL"""),
)
def incremental_ingest(spark, folder):
    """Six files of orders, one by one and all at once, through age extraction and the donor split; run twice, they stay once."""
    root = scratch_path(spark, "ingest")
    orders = load(spark, folder, "orders")
    orders.repartition(6, "o_orderkey").write.parquet(f"{root}/in")

    def to_cells(batch):
        cells = with_known_age(with_age(obs(batch.sparkSession, folder, batch)))
        return cells.select("cell_id", "donor_id", "age")

    found = []
    for files in (1, 1000):
        out, progress = f"{root}/out-{files}", f"{root}/progress-{files}"
        for _ in range(2):
            ingest_new_files(spark, f"{root}/in", orders.schema, out, progress, to_cells, files_per_batch=files)
        found.append(read_ingested(spark, out).withColumn("files_per_batch", F.lit(files)))
    return found[0].unionByName(found[1])


@query(
    "st1_stratified_ingest",
    sql("""
    , filed AS (SELECT *, cell_id % 6 AS file FROM aged WHERE age IS NOT NULL),
    firsts AS (SELECT donor_id, min(file) AS first FROM filed GROUP BY 1),
    strata AS (
      SELECT f.donor_id, first, (round_even(median(age) * 10, 0) / 10)::VARCHAR AS stratum
      FROM filed f JOIN firsts s ON f.donor_id = s.donor_id AND file = first GROUP BY 1, 2),
    placed AS (
      SELECT donor_id, row_number() OVER (PARTITION BY stratum ORDER BY first, md5('42:' || donor_id)) * 500
        + ('0x' || substr(md5('42:' || stratum), 1, 8))::BIGINT % 10000 AS reached FROM strata)
    SELECT files_per_batch, cell_id, f.donor_id, age,
      CASE WHEN reached // 10000 > (reached - 500) // 10000 THEN 'test' ELSE 'train' END AS split
    FROM filed f JOIN placed p ON f.donor_id = p.donor_id CROSS JOIN (VALUES (1), (3), (1000)) b(files_per_batch)"""),
)
def stratified_ingest(spark, folder):
    """Six files of orders, one by one, three at a time and all at once: each age stratum gets its share of test donors."""
    root = scratch_path(spark, "quota-ingest")
    orders = load(spark, folder, "orders")
    for i in range(6):
        orders.where(F.col("o_orderkey") % 6 == i).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def to_cells(batch):
        arrived = batch.select(F.col("o_orderkey").alias("cell_id"), ARRIVAL)
        cells = with_known_age(with_age(obs(batch.sparkSession, folder, batch))).join(arrived, "cell_id")
        return cells.select("cell_id", "donor_id", "age", ARRIVAL)

    found = []
    for files in (1, 3, 1000):
        out = f"{root}/out-{files}"
        ingest_with_quotas(spark, f"{root}/in", orders.schema, out, f"{root}/progress-{files}", to_cells, files_per_batch=files)
        found.append(read_ingested(spark, out).withColumn("files_per_batch", F.lit(files)))
    return found[0].unionByName(found[1]).unionByName(found[2])


def _truncate(spark, path, target, share):
    """Only the first part of a file, under another name."""
    content = spark.read.format("binaryFile").load(path).first()["content"]
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(content[: int(len(content) * share)])
    out.close()


@query(
    "c7_isolated_batch",
    sql("""
    SELECT dataset_id AS dataset_name, CASE WHEN dataset_id = 'ds_3' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
      CASE WHEN dataset_id = 'ds_3' THEN 0 ELSE count(*) END AS cells, (sum(cell_id) FILTER (dataset_id <> 'ds_3'))::BIGINT AS keys
    FROM obs GROUP BY 1"""),
)
def isolated_batch(spark, folder):
    """All datasets scanned in one job; one of them has a truncated file beside its sound ones and fails as a whole."""
    path = scratch_path(spark, "inputs")
    cells = obs(spark, folder).select("dataset_id", "cell_id", "donor_id", "tissue")
    cells.repartition("dataset_id").write.partitionBy("dataset_id").parquet(f"{path}/in")
    sound = list_files(spark, f"{path}/in/dataset_id=ds_3", "*.parquet").select("path").first()["path"]
    _truncate(spark, sound, f"{path}/in/dataset_id=ds_3/later.parquet", 0.7)
    schema = cells.drop("dataset_id").schema
    checked = materialize(spark, check_files(spark, f"{path}/in", schema, dataset=dataset_of_partition), "checked")
    built = sound_rows(spark, f"{path}/in", schema, checked, dataset=dataset_of_partition)
    planned = checked.select("dataset_name").distinct().withColumns({"action": F.lit("run"), "message": F.lit(None).cast("string")})
    report = batch_report(planned, built, broken=broken_datasets(checked)).select("dataset_name", "status", "cells")
    keys = built.groupBy(F.col("dataset_id").alias("dataset_name")).agg(F.sum("cell_id").alias("keys"))
    return report.join(keys, "dataset_name", "left")


@query(
    "c2_build_from_buckets",
    sql(f"""
    {_quota_sql("aged", 0.05)} {_sentences_sql("expr")}
    SELECT a.{_BUILT}, a.dataset_id, a.donor_id, age, split
    FROM aged a JOIN donor_split d ON a.donor_id = d.donor_id LEFT JOIN sentences s ON a.cell_id = s.cell_id WHERE age IS NOT NULL"""),
)
def built_from_buckets(spark, folder):
    """Expression stored by cell in buckets: gathered and joined where it lies."""
    cells, genes, rows = dataset_tables(spark, folder)
    mapped = map_genes(var(spark, folder), hgnc(spark, folder), ["rank"])
    path = scratch_path(spark, "expression-by-cell")
    stored = write_by_cell(rows, f"expression_by_cell_{path.rsplit('-', 1)[1]}", path, 16)
    built = build_dataset(cells, genes, stored, hgnc(spark, folder), None, gene_lists(spark, folder, mapped), OPTIONS)
    return built.select("cell_id", "dataset_id", "donor_id", "age", "split", *_SENTENCES)
