"""Table sources: Parquet chunk folders, symbol tables, gene lists, metadata slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from cellspark.operators.columns import select_fields

# Order of the lines in the symbol table.
TABLE_ROW = "table_row"

# Id columns of the symbol table that must stay text (they hold "312095|465000").
SYMBOL_TEXT_COLUMNS = (
    "omim_id",
    "ena",
    "refseq_accession",
    "ccds_id",
    "uniprot_ids",
    "pubmed_id",
    "mgd_id",
    "rgd_id",
)


def read_chunks(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """All Parquet files of a folder that match a name pattern (``chunk_*.parquet``, or Spark's own names), as one table."""
    return spark.read.option("pathGlobFilter", pattern).parquet(folder)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_datasets(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Several dataset folders as one table with ``dataset_id`` and ``split`` taken from the path.

    Folders may be named plainly (``ds/train``) or as partitions (``dataset_id=ds/split=train``).
    """
    path = F.url_decode(F.col("_metadata.file_path"))
    df = spark.read.option("recursiveFileLookup", "true").parquet(*folders)
    return df.withColumns(
        {
            "dataset_id": F.regexp_extract(path, r"/(?:dataset_id=)?([^/=]+)/(?:split=)?(?:train|test)/[^/]+$", 1),
            "split": F.regexp_extract(path, r"/(?:split=)?(train|test)/[^/]+$", 1),
        }
    )


def read_symbol_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Tab-separated symbol table; the listed id columns are always text. Adds ``table_row``.

    Without a schema only the header is read first; all columns come as text, which is what the
    join on id and symbol needs, and saves a pass over the file to guess types.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", "")
    if schema is None:
        return _with_table_row(reader.csv(path))
    fixed = [T.StructField(f.name, T.StringType()) if f.name in SYMBOL_TEXT_COLUMNS else f for f in schema]
    return _with_table_row(reader.schema(T.StructType(fixed)).csv(path))


def _with_table_row(symbols: DataFrame) -> DataFrame:
    """Numbers that grow with the lines of the file, so that the first of several symbols can be kept."""
    return symbols.withColumn(TABLE_ROW, F.monotonically_increasing_id())


def read_typed_symbol_table(spark: SparkSession, path: str) -> DataFrame:
    """Symbol table with types guessed from the file, but the listed id columns kept as text."""
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", "")
    return read_symbol_table(spark, path, reader.option("inferSchema", True).csv(path).schema)


def read_gene_lists(spark: SparkSession, folder: str) -> DataFrame:
    """``(list_name, symbol)`` from every ``.txt`` file of a folder; empty if there is none."""
    try:
        lines = spark.read.option("pathGlobFilter", "*.txt").text(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "list_name string, symbol string")
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "")
    return clean_gene_lists(lines.select(name.alias("list_name"), F.col("value").alias("symbol")))


def clean_gene_lists(lines: DataFrame) -> DataFrame:
    """Strip symbols, drop blank lines, keep each symbol once per list."""
    stripped = lines.withColumn("symbol", F.regexp_replace("symbol", r"^\s+|\s+$", ""))
    return stripped.filter(F.col("symbol") != "").select("list_name", "symbol").distinct()


def gene_list_names(gene_lists: DataFrame) -> list[str]:
    """List names in order; there are as many as files in the lists folder."""
    return [row["list_name"] for row in gene_lists.select("list_name").distinct().orderBy("list_name").collect()]


def scan_metadata(
    df: DataFrame, fields: list[str] | None, row: str | None = None, start: int = 0, end: int | None = None
) -> DataFrame:
    """Chosen columns, optionally only rows ``start <= row < end``; both reach the Parquet scan."""
    rows = df
    if row is not None:
        rows = rows.filter(F.col(row) >= start)
        rows = rows if end is None else rows.filter(F.col(row) < end)
    return select_fields(rows, fields)
