"""Metrics out of a JSON-lines event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric -> (message that carries it, field of that message).
LOG_METRICS = {
    "total_cells": ("age_extraction_summary", "total_cells"),
    "cells_with_valid_age": ("age_extraction_summary", "cells_with_valid_age"),
    "cells_with_null_age": ("age_extraction_summary", "cells_with_null_age"),
    "genes_total": ("gene_mapping_summary", "total_genes"),
    "genes_mapped_hgnc": ("gene_mapping_summary", "mapped_via_hgnc"),
    "genes_mapped_fallback": ("gene_mapping_summary", "mapped_via_fallback"),
    "genes_unmapped": ("gene_mapping_summary", "unmapped_using_ensembl_id"),
    "cells_discarded_in_split": ("filtering_summary", "cells_discarded"),
}
MISSING_MESSAGE = "warning_missing_column"
SAMPLE_MESSAGE = "sample_null_age_development_stages"
NULL_AGE_LIMIT = 0.1
UNMAPPED_LIMIT = 0.05


def last_value(value: Column, time: Column, wanted: Column) -> Column:
    """Aggregate: ``value`` of the latest row for which ``wanted`` holds."""
    return F.max_by(value, F.when(wanted, time))


def log_metrics(events: DataFrame) -> DataFrame:
    """One row: last value of every metric (0 if never logged), the names of missing columns, sorted, as often as they were logged,
    and the stages of the last sample of cells without an age."""
    message, time = F.col("message_type"), F.col("timestamp")
    metrics = []
    for name, (kind, field) in LOG_METRICS.items():
        found = last_value(F.col(field), time, message == kind) if field in events.columns else F.lit(0)
        metrics.append(F.coalesce(found, F.lit(0)).cast("bigint").alias(name))
    column = F.when(message == MISSING_MESSAGE, F.col("column")) if "column" in events.columns else F.lit(None)
    metrics.append(F.sort_array(F.collect_list(column.cast("string"))).alias("missing_columns"))
    if "samples" in events.columns:
        stages = F.transform("samples", lambda s: s["development_stage"])
        metrics.append(last_value(stages, time, message == SAMPLE_MESSAGE).alias("sample_null_ages"))
    return events.agg(*metrics)


def missing_columns(events: DataFrame) -> DataFrame:
    """How often each column was logged as missing."""
    logged = events.filter(F.col("message_type") == MISSING_MESSAGE)
    return logged.groupBy("column").agg(F.count("*").alias("events"))


def log_advice(metrics: DataFrame) -> DataFrame:
    """Add the shares of null ages and unmapped genes and whether each is too high."""
    null_share = F.col("cells_with_null_age") / F.greatest("total_cells", F.lit(1))
    unmapped_share = F.col("genes_unmapped") / F.greatest("genes_total", F.lit(1))
    return metrics.withColumns(
        {
            "null_age_share": F.round(null_share, 4),
            "unmapped_share": F.round(unmapped_share, 4),
            "too_many_null_ages": null_share > NULL_AGE_LIMIT,
            "too_many_unmapped_genes": unmapped_share > UNMAPPED_LIMIT,
        }
    )


def last_by_message(events: DataFrame, message: str, value: str, time: str) -> DataFrame:
    """Events, last value and last time per message type."""
    return events.groupBy(message).agg(
        F.count("*").alias("events"), F.max_by(value, time).alias("last_value"), F.max(time).alias("last_time")
    )
