"""File listings and JSON sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.operators.publications import COLLECTION_SCHEMA, flatten_collections

# Fields of the event log that the metrics read.
LOG_SCHEMA = (
    "message_type string, action_type string, action_status string, timestamp double, task_uuid string, "
    "task_level array<bigint>, column string, total_cells bigint, cells_with_valid_age bigint, "
    "cells_with_null_age bigint, total_genes bigint, mapped_via_hgnc bigint, mapped_via_fallback bigint, "
    "unmapped_using_ensembl_id bigint, cells_discarded bigint, count bigint, "
    "samples array<struct<development_stage:string>>"
)


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``(path, length, modificationTime)`` of files; their content is not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    return reader.load(folder).select("path", "length", "modificationTime")


def entry_of(folder: str, path: Column) -> Column:
    """The file or folder directly below ``folder`` that a listed path is or lies in."""
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    return F.substring_index(F.substring_index(path, f"/{name}/", -1), "/", 1)


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines log with a fixed schema, so that no pass is spent on guessing one."""
    return spark.read.schema(LOG_SCHEMA).json(path)


def parse_event_log(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(F.from_json(column, LOG_SCHEMA).alias("e")).select("e.*")


def read_collections(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Nested collection records -> one row per dataset."""
    return flatten_collections(spark.read.schema(COLLECTION_SCHEMA).option("multiLine", multi_line).json(path))
