"""Inputs that may be broken: one job over all files, the broken ones found out and left out with their datasets.

A tolerant scan gives up a file where it cannot be read on, without saying so. What it gave is therefore held against
the list of files and against the row counts in their footers: a file is sound if its footer can be read and all of
its rows were decoded. Results hold whole datasets only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions.text import path_stem, sanitize_name
from cellspark.sources.files import list_files

MISSING_FOOTER = "unreadable"


def plain_path(path: Column) -> Column:
    """A file's path as listings write it, without escapes and with one slash after the scheme."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", r"$1:/")


def dataset_of_stem(path: Column) -> Column:
    """The dataset of a file named after it."""
    return sanitize_name(path_stem(path))


def dataset_of_partition(path: Column) -> Column:
    """The dataset of a file in a folder ``dataset_id=...``."""
    return F.regexp_extract(path, r"/dataset_id=([^/]+)/", 1)


def _decoded(path: Column) -> Column:
    """Readers write paths with escapes, in which a plus sign is itself."""
    return plain_path(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def tolerant_scan(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet") -> DataFrame:
    """All rows that can be read, with ``source_file``; checksums of pages are looked at where files have them."""
    reader = spark.read.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    rows = reader.option("parquet.page.verify-checksum.enabled", "true").parquet(folder)
    return rows.withColumn("source_file", _decoded(F.col("_metadata.file_path")))


def check_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    dataset: Callable[[Column], Column] = dataset_of_stem,
) -> DataFrame:
    """``path, length, dataset_name, rows`` (by the footer), ``decoded`` (rows) and ``sound`` of every file.

    All columns of ``schema`` are decoded once; files without a row count as not sound. Nothing is shuffled but
    one row per file and task.
    """
    scan = tolerant_scan(spark, folder, schema, pattern)
    footers = scan.groupBy(F.col("source_file").alias("path")).agg(F.count("*").alias("rows"))
    # The hash needs every value, so every page is decoded.
    touched = scan.select("source_file", F.xxhash64(*[f.name for f in schema]).alias("hash"))
    decoded = touched.groupBy(F.col("source_file").alias("path")).agg(F.count("*").alias("decoded"), F.bit_xor("hash").alias("hash"))
    # Listings leave out files without a byte; the driver's list of files, which any scan makes, has them.
    names = spark.createDataFrame([(f,) for f in scan.inputFiles()], "path string").select(_decoded(F.col("path")).alias("path"))
    sizes = list_files(spark, folder, pattern).select(plain_path(F.col("path")).alias("path"), "length")
    listed = names.join(sizes, "path", "left").fillna(0, ["length"])
    met = listed.join(footers, "path", "left").join(decoded, "path", "left")
    sound = F.coalesce(F.col("rows") == F.col("decoded"), F.lit(False))
    # The hash takes part so that it is not optimised away; it is never null where rows were decoded.
    sound = sound & F.col("hash").isNotNull()
    return met.select("path", "length", dataset(F.col("path")).alias("dataset_name"), "rows", F.coalesce("decoded", F.lit(0)).alias("decoded"), sound.alias("sound"))


def broken_datasets(checked: DataFrame) -> DataFrame:
    """``dataset_name, message`` of datasets with a file that is not sound; ``checked`` is stored."""
    of_file = F.when(F.col("rows").isNull(), F.concat(F.lit(f"{MISSING_FOOTER}: "), "path")).otherwise(
        F.format_string("%d of %d rows read: %s", F.col("decoded"), F.col("rows"), F.col("path"))
    )
    return checked.where(~F.col("sound")).groupBy("dataset_name").agg(F.min(of_file).alias("message"))


def sound_rows(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    checked: DataFrame,
    pattern: str = "*.parquet",
    dataset: Callable[[Column], Column] = dataset_of_stem,
) -> DataFrame:
    """Rows of the datasets whose files are all sound, with ``dataset_id``; one scan for all of them.

    Broken datasets are few or a run is not worth its while; the planner broadcasts their names if they are.
    """
    rows = tolerant_scan(spark, folder, schema, pattern).withColumn("dataset_id", dataset(F.col("source_file"))).drop("source_file")
    return rows.join(broken_datasets(checked).select(F.col("dataset_name").alias("dataset_id")), "dataset_id", "left_anti")
