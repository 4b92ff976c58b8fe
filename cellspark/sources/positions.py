"""Positions of stored rows: files in order of their names, rows in the order they have in their file.

A position is the number of rows in earlier files plus the row's place in its own, which Parquet readers know. So
numbering, paging and row ranges sort nothing and move no row; only row counts per file, which are read from footers,
are put in line.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.operators.columns import select_fields
from cellspark.sources.tables import read_chunks

# Tables with more files than this are numbered by a shuffled join instead of a broadcast of one row per file.
BROADCAST_FILES = 200_000


@dataclass(frozen=True)
class StoredFile:
    path: str
    rows: int
    first: int

    @property
    def end(self) -> int:
        return self.first + self.rows


def stored_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> list[StoredFile]:
    """The files of a folder in order, with the position of their first row; the driver lists them for any scan anyway."""
    counts = read_chunks(spark, folder, pattern).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n")).collect()
    files, first = [], 0
    for row in sorted(counts, key=lambda r: unquote(r["file"])):
        files.append(StoredFile(row["file"], row["n"], first))
        first += row["n"]
    return files


def _read_files(spark: SparkSession, folder: str, files: list[StoredFile]) -> DataFrame:
    """Only these files. Characters that a path pattern would take for its own are escaped."""
    paths = [unquote(f.path) if urlparse(f.path).scheme else f.path for f in files]
    escaped = ["".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path) for path in paths]
    plain = re.sub(r"\\(.)", r"\1", folder)
    is_pattern = re.search(r"(?<!\\)[*?\[{]", folder)
    is_file = paths[0].endswith("/" + plain.split(":")[-1].strip("/"))
    # Columns that folders below this one stand for are found from the folder on.
    reader = spark.read if is_pattern or is_file else spark.read.option("basePath", plain)
    return reader.parquet(*escaped)


def _numbered(rows: DataFrame, files: list[StoredFile], name: str) -> DataFrame:
    spark, columns = rows.sparkSession, rows.columns
    firsts = spark.createDataFrame([(f.path, f.first) for f in files], "_file string, _first bigint")
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    placed = placed.join(F.broadcast(firsts) if len(files) <= BROADCAST_FILES else firsts, "_file")
    return placed.select(*columns, (F.col("_first") + F.col("_place")).alias(name))


def with_positions(
    spark: SparkSession,
    folder: str,
    name: str = "row_idx",
    fields: list[str] | None = None,
    pattern: str = "*.parquet",
    files: list[StoredFile] | None = None,
) -> DataFrame:
    """All rows of a folder with their position, 0 to n - 1; ``files`` from :func:`stored_files` saves the look at the footers."""
    rows = read_chunks(spark, folder, pattern)
    files = stored_files(spark, folder, pattern) if files is None else files
    return _numbered(rows if fields is None else select_fields(rows, fields), files, name)


def scan_rows(
    spark: SparkSession,
    folder: str,
    start: int = 0,
    end: int | None = None,
    fields: list[str] | None = None,
    name: str | None = None,
    pattern: str = "*.parquet",
    files: list[StoredFile] | None = None,
) -> DataFrame:
    """Rows ``start <= position < end``; only files that hold some of them are read. ``name`` adds the position.

    ``files`` from :func:`stored_files` saves the look at the footers for the second and later ranges.
    """
    if start < 0 or (end is not None and end < start):
        raise ValueError("a row range needs 0 <= start <= end")
    files = stored_files(spark, folder, pattern) if files is None else files
    stop = (files[-1].end if files else 0) if end is None else end
    held = [f for f in files if f.first < stop and f.end > start]
    if not held or stop == start:
        rows = read_chunks(spark, folder, pattern).limit(0)
        rows = rows if fields is None else select_fields(rows, fields)
        return rows if name is None else rows.withColumn(name, F.lit(0).cast("bigint"))
    rows = _read_files(spark, folder, held)
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    if start > held[0].first:
        rows = rows.where((file != held[0].path) | (place >= start - held[0].first))
    if stop < held[-1].end:
        rows = rows.where((file != held[-1].path) | (place < stop - held[-1].first))
    rows = rows if fields is None else select_fields(rows, fields)
    return rows if name is None else _numbered(rows, held, name)


def page(spark: SparkSession, folder: str, offset: int, rows: int, fields: list[str] | None = None, name: str = "row_idx", pattern: str = "*.parquet") -> DataFrame:
    """One page of stored rows, in order."""
    return scan_rows(spark, folder, offset, offset + rows, fields, name, pattern).orderBy(name)


def row_ranges(spark: SparkSession, folder: str, rows: int, pattern: str = "*.parquet") -> list[tuple[int, int]]:
    """Ranges of ``rows`` rows that together cover the folder, the last one shorter."""
    if rows < 1:
        raise ValueError("a range holds one row at least")
    files = stored_files(spark, folder, pattern)
    total = files[-1].end if files else 0
    return [(start, min(start + rows, total)) for start in range(0, total, rows)]
