"""Sources and sinks: what is written is read back from the shared scratch folder."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions.text import path_stem
from cellspark.operators.columns import fill_missing_text
from cellspark.operators.sentences import densify, to_long, to_sparse
from cellspark.operators.splits import split_donors_by_hash
from cellspark.operators.summaries import by_organism, dataset_summaries
from cellspark.session import scratch_path
from cellspark.sinks.parquet import (
    rechunk,
    symbol_table_to_parquet,
    write_all_splits,
    write_by_rows,
    write_by_size,
    write_chunks,
    write_exact_rows,
    write_exact_split,
    write_parquet,
    write_split,
)
from cellspark.sinks.summaries import write_by_organism, write_summary
from cellspark.sources.files import entry_of, list_files, read_collections, read_event_log
from cellspark.sources.positions import page, row_ranges, scan_rows, stored_files, with_positions
from cellspark.sources.tables import (
    TABLE_ROW,
    clean_gene_lists,
    read_chunks,
    read_datasets,
    read_table,
    read_typed_symbol_table,
    scan_metadata,
)
from workload.aggregates import LOG_MESSAGES, SUMMARY_SQL, log_lines, meta
from workload.registry import query
from workload.tables import collections, expr, hgnc, load, obs, panel_columns, panel_expr, sql, uniform_sql


@query("s1_chunk_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def chunk_scan(spark, folder):
    return read_chunks(spark, folder, "orders*.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@query("s2_table_read", "SELECT p_partkey, p_name FROM part")
def table_read(spark, folder):
    return read_table(spark, f"{folder}/part.parquet").select("p_partkey", "p_name")


def _symbol_tsv(spark, folder):
    """The symbol table as a TSV file with one multi-valued id column."""
    path = scratch_path(spark, "symbols-tsv")
    ids = F.concat_ws("|", F.col("rank").cast("string"), F.lit("465000"))
    table = hgnc(spark, folder).withColumn("omim_id", F.when(F.col("rank") == 1, "312095").otherwise(ids))
    table.write.option("sep", "\t").option("header", True).csv(path)
    return path


_TSV_SQL = sql("""
    SELECT ensembl_gene_id, symbol, rank, CASE WHEN rank = 1 THEN '312095' ELSE rank || '|465000' END AS omim_id FROM hgnc""")


@query("s3_symbol_tsv", _TSV_SQL)
def symbol_tsv(spark, folder):
    return read_typed_symbol_table(spark, _symbol_tsv(spark, folder)).drop(TABLE_ROW)


@query("k8_tsv_to_parquet", _TSV_SQL)
def tsv_to_parquet(spark, folder):
    path = scratch_path(spark, "symbols")
    symbol_table_to_parquet(spark, _symbol_tsv(spark, folder), path)
    return read_table(spark, path).drop(TABLE_ROW)


@query(
    "s4_gene_list_lines",
    r"""
    SELECT DISTINCT lang AS list_name, regexp_replace(line, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS symbol
    FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE regexp_replace(line, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') <> ''""",
)
def gene_list_lines(spark, folder):
    """Every line of a text, stripped, once per list."""
    lines = F.explode(F.split("text", "\n")).alias("symbol")
    return clean_gene_lists(load(spark, folder, "documents").select(F.col("lang").alias("list_name"), lines))


@query(
    "s5_event_log_scan",
    """SELECT event_type, (props->>'$.k')::BIGINT AS cells_discarded, 'column_' || (props->>'$.k') AS "column"
    FROM events WHERE event_type IN ('error', 'signup')""",
)
def event_log_scan(spark, folder):
    path = scratch_path(spark, "event-log")
    log_lines(spark, folder).write.text(path)
    wanted = {LOG_MESSAGES[e]: e for e in ("error", "signup")}
    events = read_event_log(spark, path).filter(F.col("message_type").isin(list(wanted)))
    kind = F.when(F.col("message_type") == LOG_MESSAGES["error"], "error").otherwise("signup")
    return events.select(kind.alias("event_type"), "cells_discarded", "column")


@query(
    "s6_nested_collections",
    """SELECT 'ds_' || n_nationkey AS dataset_id, 'col_' || r_regionkey AS collection_id, r_name AS title,
      CASE WHEN r_name <> 'EUROPE' THEN '10.1000/' || r_regionkey END AS doi, '' AS description,
      lower(r_name) AS contact_name, '' AS contact_email
    FROM region JOIN nation ON n_regionkey = r_regionkey WHERE n_nationkey <> 7""",
)
def nested_collections(spark, folder):
    """Regions as collections of nations; ids missing, empty or under the second name; one without any id."""
    key = F.concat(F.lit("ds_"), F.col("n_nationkey"))
    other = F.col("n_nationkey") > 12
    dataset = F.struct(
        F.when(F.col("n_nationkey") == 7, F.lit("")).when(~other, key).alias("id"),
        F.when(other, key).alias("dataset_id"),
    )
    datasets = load(spark, folder, "nation").groupBy("n_regionkey").agg(F.collect_list(dataset).alias("datasets"))
    regions = load(spark, folder, "region").join(datasets, F.col("r_regionkey") == F.col("n_regionkey"))
    record = F.struct(
        F.concat(F.lit("col_"), F.col("r_regionkey")).alias("collection_id"),
        F.col("r_name").alias("name"),
        F.when(F.col("r_name") != "EUROPE", F.concat(F.lit("10.1000/"), F.col("r_regionkey"))).alias("doi"),
        F.lower("r_name").alias("contact_name"),
        "datasets",
    )
    path = scratch_path(spark, "collections")
    regions.select(F.to_json(record)).write.text(path)
    return read_collections(spark, path, multi_line=False)


@query("s7_metadata_scan", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey >= 500 AND o_orderkey < 1400")
def metadata_scan(spark, folder):
    """A range of rows, which is the feature."""
    return scan_metadata(load(spark, folder, "orders"), ["o_orderkey", "o_orderstatus", "not_there"], "o_orderkey", 500, 1400)


@query(
    "s8_dense_expression",
    sql("""
    SELECT s.dataset_id, s.cell_id, list(coalesce(value, 0.0::DOUBLE) ORDER BY p_partkey) AS expression
    FROM (SELECT DISTINCT dataset_id, cell_id FROM panel_supplier_expr) s
    JOIN part ON dataset_id = 'block_' || (p_partkey // 1000)
    LEFT JOIN supplier_expr e ON e.cell_id = s.cell_id AND e.gene_idx = p_partkey GROUP BY 1, 2"""),
)
def dense_expression(spark, folder):
    """Suppliers as cells: stored entries put into a row as long as the dataset has genes, zeros filled in."""
    cells = to_sparse(panel_expr(spark, folder, "l_suppkey"), ["dataset_id", "cell_id"])
    genes = load(spark, folder, "part").select(panel_columns(F.col("p_partkey"))["dataset_id"].alias("dataset_id"))
    sized = cells.join(genes.groupBy("dataset_id").agg(F.count("*").alias("n_genes")), "dataset_id")
    return densify(sized, "n_genes").select("dataset_id", "cell_id", "expression")


@query("s8_sparse_round_trip", sql("SELECT cell_id, gene_idx::INTEGER AS gene_idx, value FROM expr"))
def sparse_round_trip(spark, folder):
    return to_long(to_sparse(expr(spark, folder), ["cell_id"]), ["cell_id"])


_LISTED_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(
    "s9_file_inventory",
    " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows, true AS has_bytes FROM {t}" for t in _LISTED_TABLES),
)
def file_inventory(spark, folder):
    """All listed tables, each a file or a folder of files, with the rows that Spark reads from each; one without rows has 0."""
    table = path_stem(entry_of(folder, F.col("path"))).alias("name")
    files = list_files(spark, folder, "*.parquet").groupBy(table).agg(F.bool_and(F.col("length") > 0).alias("has_bytes"))
    names = [r["name"] for r in files.select("name").collect()]
    rows = [load(spark, folder, t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("name"), "rows") for t in names]
    return files.join(functools.reduce(DataFrame.unionByName, rows), "name").select("name", "rows", "has_bytes")


_BY_STATUS = "SELECT o_orderstatus, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1"


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))


@query("k1_parquet_write", _BY_STATUS)
def parquet_write(spark, folder):
    path = scratch_path(spark, "orders")
    write_parquet(load(spark, folder, "orders"), path)
    return _by_status(read_table(spark, path))


def _rows_per_file(spark, path):
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("rows"), (F.max("n") <= 1000).alias("within_limit"))


@query("k2_write_by_rows", "SELECT count(*) AS rows, true AS within_limit FROM orders")
def rows_write(spark, folder):
    path = scratch_path(spark, "orders-by-rows")
    write_by_rows(load(spark, folder, "orders"), path, 1000)
    return _rows_per_file(spark, path)


def _named_files(spark, path):
    """Rows that the file names state, and rows and keys that are there."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d+)_(\d+)\.parquet$", 1).cast("bigint").alias("first")
    end = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d+)_(\d+)\.parquet$", 2).cast("bigint").alias("end")
    return read_chunks(spark, path).select("*", name, end)


@query(
    "k2_exact_chunks",
    """
    SELECT (o_orderkey_place // 700) * 700 AS first, least((o_orderkey_place // 700 + 1) * 700, any_value(total)) AS end,
      count(*) AS rows, sum(o_orderkey)::BIGINT AS keys
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS o_orderkey_place, count(*) OVER () AS total FROM orders)
    GROUP BY o_orderkey_place // 700""",
)
def exact_chunks(spark, folder):
    """Orders sorted into many small partitions; every file but the last has exactly 700 rows, in order."""
    path = scratch_path(spark, "exact-orders")
    write_exact_rows(load(spark, folder, "orders").repartitionByRange(23, "o_orderkey").sortWithinPartitions("o_orderkey"), path, 700, "orders")
    files = _named_files(spark, path).groupBy("first", "end")
    return files.agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))


@query(
    "k5_rechunk_stored",
    """
    SELECT l_place // 2500 AS chunk, count(*) AS rows, sum(l_orderkey)::BIGINT AS keys
    FROM (SELECT l_orderkey, row_number() OVER () - 1 AS l_place FROM lineitem) GROUP BY 1""",
)
def rechunk_stored(spark, folder):
    """A stored table again, in its own order, in files of exactly 2500 rows."""
    path = scratch_path(spark, "rechunked")
    rechunk(spark, f"{folder}/lineitem.parquet", path, 2500, "lineitem")
    chunk = F.floor(F.col("first") / 2500).alias("chunk")
    return _named_files(spark, path).groupBy(chunk).agg(F.count("*").alias("rows"), F.sum("l_orderkey").alias("keys"))


@query(
    "k4_exact_split_chunks",
    sql(f"""
    , sided AS (SELECT CASE WHEN {uniform_sql("donor_id")} < 0.05 THEN 'test' ELSE 'train' END AS split FROM obs),
    sizes AS (SELECT split, count(*) AS n FROM sided GROUP BY 1)
    SELECT split, unnest(range(0, n, 400)) AS first, least(n - first, 400) AS rows FROM sizes"""),
)
def exact_split_chunks(spark, folder):
    path = scratch_path(spark, "exact-split-chunks")
    write_exact_split(_split_cells(spark, folder), path, "orders", 400)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d+)_\d+\.parquet$", 1).cast("bigint").alias("first")
    return spark.read.parquet(f"{path}/orders").groupBy("split", name).agg(F.count("*").alias("rows"))


@query(
    "p14_stored_positions",
    "SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER () - 1 AS row_idx FROM lineitem",
)
def stored_positions(spark, folder):
    return with_positions(spark, f"{folder}/lineitem.parquet", fields=["l_orderkey", "l_partkey", "l_linenumber"])


@query("t7_stored_page", "SELECT o_orderkey, o_orderstatus, row_number() OVER () - 1 AS row_idx FROM orders LIMIT 50 OFFSET 100")
def stored_page(spark, folder):
    return page(spark, f"{folder}/orders.parquet", 100, 50, ["o_orderkey", "o_orderstatus"])


@query(
    "s7_row_ranges",
    """
    SELECT row_idx // (total // 7 + 1) AS range_number, count(*) AS rows, min(row_idx) AS first, max(row_idx) AS last,
      sum(o_orderkey)::BIGINT AS keys
    FROM (SELECT o_orderkey, row_number() OVER () - 1 AS row_idx, (SELECT count(*) FROM orders) AS total FROM orders) GROUP BY 1""",
)
def ranges_of_rows(spark, folder):
    """Orders in four files, read range by range: seven ranges that together cover the table."""
    path, total = scratch_path(spark, "orders-in-files"), load(spark, folder, "orders").count()
    rechunk(spark, f"{folder}/orders.parquet", path, -(-total // 4), "orders")
    files = stored_files(spark, path)
    spans = row_ranges(spark, path, total // 7 + 1)
    rows = [
        scan_rows(spark, path, start, end, ["o_orderkey"], "row_idx", files=files).withColumn("range_number", F.lit(i).cast("bigint"))
        for i, (start, end) in enumerate(spans)
    ]
    grouped = functools.reduce(DataFrame.unionByName, rows).groupBy("range_number")
    return grouped.agg(F.count("*").alias("rows"), F.min("row_idx").alias("first"), F.max("row_idx").alias("last"), F.sum("o_orderkey").alias("keys"))


@query("k3_write_by_size", "SELECT count(*) AS rows, true AS not_too_large, true AS not_too_small FROM lineitem")
def size_write(spark, folder):
    """Files of about 0.05 MB, from many small partitions."""
    path, target = scratch_path(spark, "lineitem-by-size"), 0.05
    write_by_size(load(spark, folder, "lineitem").repartition(32), path, target)
    files = list_files(spark, path, "*.parquet").select((F.col("length") / (target * 1024 * 1024)).alias("share"))
    found = files.agg(F.min("share").alias("least"), F.max("share").alias("most"), F.count("*").alias("n")).first()
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
    return rows.withColumns({"not_too_large": F.lit(found.most < 1.3), "not_too_small": F.lit(found.n == 1 or found.least > 0.5)})


_SPLIT_SQL = f"""
    SELECT {{dataset}} AS dataset_id, CASE WHEN {uniform_sql("donor_id")} < 0.05 THEN 'test' ELSE 'train' END AS split,
      count(*) AS cells, sum(cell_id)::BIGINT AS keys FROM obs GROUP BY 1, 2"""


def _split_cells(spark, folder):
    return split_donors_by_hash(obs(spark, folder).select("dataset_id", "cell_id", "donor_id", "tissue"), "donor_id")


def _side_sizes(df):
    return df.groupBy("dataset_id", "split").agg(F.count("*").alias("cells"), F.sum("cell_id").alias("keys"))


@query("k4_split_folders", sql(_SPLIT_SQL.format(dataset="'orders'")))
def split_folders(spark, folder):
    path = scratch_path(spark, "split")
    write_split(_split_cells(spark, folder), path, "orders", chunk_size=10000)
    return _side_sizes(read_datasets(spark, [f"{path}/orders"]))


@query("k4_all_datasets_split", sql(_SPLIT_SQL.format(dataset="dataset_id")))
def all_datasets_split(spark, folder):
    path = scratch_path(spark, "all-splits")
    write_all_splits(_split_cells(spark, folder), path, chunk_size=10000)
    return _side_sizes(spark.read.parquet(path))


@query("k5_unsplit_chunks", _BY_STATUS)
def unsplit_chunks(spark, folder):
    path = scratch_path(spark, "unsplit")
    write_chunks(load(spark, folder, "orders"), path, chunk_size=5000)
    return _by_status(read_table(spark, path))


def _summary(spark, folder):
    return dataset_summaries(fill_missing_text(meta(spark, folder)))


_SUMMARY_COLUMNS = "dataset_id, total_cells, organism, unique_donors, age_years_mean, tissues, unique_ages_years"


@query("k6_summary_tsv", sql(f"{SUMMARY_SQL} SELECT {_SUMMARY_COLUMNS} FROM summary"))
def summary_tsv(spark, folder):
    summary = _summary(spark, folder)
    path = scratch_path(spark, "summary")
    write_summary(summary, path, "tsv")
    stored = spark.read.schema(summary.schema).option("sep", "\t").option("header", True).csv(path)
    return stored.select(*_SUMMARY_COLUMNS.split(", "))


@query("k7_scan_to_parquet", sql("SELECT cell_id, tissue FROM obs WHERE organism = 'Mus musculus'"))
def scan_to_parquet(spark, folder):
    path = scratch_path(spark, "mouse-cells")
    cells = obs(spark, folder).filter(F.col("organism") == "Mus musculus").select("cell_id", "tissue")
    write_parquet(cells, path)
    return read_table(spark, path)


_ORGANISM_SQL = """
    SELECT dataset_id, total_cells, organism, translate(lower(organism), ' -', '__') AS organism_key FROM summary
    WHERE organism IS NOT NULL AND organism NOT IN ('', 'unknown')"""


@query("k9_files_by_organism", sql(f"{SUMMARY_SQL} {_ORGANISM_SQL}"))
def files_by_organism(spark, folder):
    summary = _summary(spark, folder)
    path = scratch_path(spark, "by-organism")
    write_by_organism(summary, path)
    schema = by_organism(summary).schema
    stored = spark.read.schema(schema).option("header", True).csv(path)
    return stored.select("dataset_id", "total_cells", "organism", "organism_key")


@query(
    "k4_training_mixture",
    sql(f"""
    SELECT 'part_' || CASE WHEN dataset_id < 'ds_2' THEN 'a' ELSE 'b' END AS dataset_id,
      CASE WHEN {uniform_sql("donor_id")} < 0.05 THEN 'test' ELSE 'train' END AS split, count(*) AS cells,
      sum(cell_id)::BIGINT AS keys
    FROM obs GROUP BY 1, 2"""),
)
def training_mixture(spark, folder):
    """Several dataset folders read back as one table, dataset and side taken from the path."""
    path = scratch_path(spark, "mixture")
    cells = _split_cells(spark, folder)
    first = F.col("dataset_id") < "ds_2"
    write_split(cells.filter(first), path, "part_a")
    write_split(cells.filter(~first), path, "part_b")
    return _side_sizes(read_datasets(spark, [f"{path}/part_a", f"{path}/part_b"]))


@query(
    "s2_collections_cache",
    sql("SELECT dataset_id, collection_id, title, doi FROM collections"),
)
def collections_cache(spark, folder):
    """The flattened collections kept as a Parquet table and read again."""
    path = scratch_path(spark, "collections-cache")
    write_parquet(collections(spark, folder), path)
    return read_table(spark, path).select("dataset_id", "collection_id", "title", "doi")
