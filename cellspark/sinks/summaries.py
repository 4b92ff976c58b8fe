"""CSV/TSV sinks of summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cellspark.operators.summaries import by_organism

SEPARATORS = {"csv": ",", "tsv": "\t"}


def separator_for(fmt: str) -> str:
    if fmt.lower() not in SEPARATORS:
        raise ValueError(f"Invalid summary format: {fmt}. Must be 'csv' or 'tsv'")
    return SEPARATORS[fmt.lower()]


def write_summary(summary: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """One delimited file with a header; summaries have one row per dataset."""
    writer = summary.repartition(1).write.mode(mode).option("header", True)
    writer.option("sep", separator_for(fmt)).csv(path)


def write_by_organism(summary: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """One folder per organism, named by its key; unknown organisms are skipped."""
    writer = by_organism(summary).repartition(1).write.mode(mode).option("header", True)
    writer.partitionBy("organism_key").option("sep", separator_for(fmt)).csv(path)
