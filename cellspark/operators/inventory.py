"""File inventories: size limits, finished outputs, age of files, storage and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions.text import gigabytes, hms, megabytes, path_stem, sanitize_name

SUCCESS, FAILED, SKIPPED = "SUCCESS", "FAILED", "SKIPPED"
EXISTS_MESSAGE = "Output files already exist"


def within_size(limit_mb: float | None) -> Column:
    """File is not larger than the limit; a file of exactly that size is accepted."""
    return F.lit(True) if limit_mb is None else megabytes(F.col("length")) <= limit_mb


def size_message(limit_mb: float | None) -> Column:
    """Why a file was left out."""
    return F.format_string(f"skipped (file too large: %.2f MB > {limit_mb} MB)", megabytes(F.col("length")))


def filter_by_size(files: DataFrame, limit_mb: float | None) -> DataFrame:
    return files.filter(within_size(limit_mb))


def with_dataset_name(files: DataFrame) -> DataFrame:
    """Add the output folder name each input file gets."""
    return files.withColumn("dataset_name", sanitize_name(path_stem(F.col("path"))))


def finished_datasets(outputs: DataFrame, skip_split: bool = False) -> DataFrame:
    """Datasets with a Parquet file in a split folder (or in the dataset folder if not split).

    Folders may be named plainly (``ds/train``) or as partitions (``dataset_id=ds/split=train``).
    """
    name = r"(?:dataset_id=)?([^/=]+)/"
    side = "" if skip_split else r"(?:split=)?(?:train|test)/"
    name = F.regexp_extract("path", rf"(?:^|/){name}{side}[^/]+\.parquet$", 1)
    return outputs.select(name.alias("dataset_name")).filter(F.col("dataset_name") != "").distinct()


def filter_unfinished(files: DataFrame, outputs: DataFrame, skip_split: bool = False) -> DataFrame:
    """Input files whose dataset has no output yet."""
    return with_dataset_name(files).join(finished_datasets(outputs, skip_split), "dataset_name", "left_anti")


def older_than(files: DataFrame, days: int, now: Column | None = None) -> DataFrame:
    """Files not modified for ``days`` days."""
    moment = F.current_timestamp() if now is None else now
    return files.filter(F.col("modificationTime") < moment - F.make_dt_interval(F.lit(days)))


def inventory_totals(files: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("length"), F.lit(0))
    return files.agg(
        F.count("*").alias("files"), total.alias("total_bytes"), F.round(megabytes(total), 2).alias("total_mb")
    )


def storage_by(files: DataFrame, *by: str) -> DataFrame:
    """Files, bytes, MB and GB per group."""
    total = F.sum("length")
    return files.groupBy(*by).agg(
        F.count("*").alias("files"),
        total.alias("bytes"),
        F.round(megabytes(total), 2).alias("mb"),
        F.round(gigabytes(total), 4).alias("gb"),
    )


def run_report(results: DataFrame) -> DataFrame:
    """Results ``(dataset_name, status, seconds, output_path, message)`` as the batch report."""
    seconds = F.when(F.col("status") == SKIPPED, F.lit(0.0)).otherwise(F.col("seconds"))
    crash = F.concat(F.lit("CRASH: "), F.col("message"))
    return results.select(
        "dataset_name",
        "status",
        F.round(seconds, 2).alias("processing_time_seconds"),
        hms(seconds).alias("processing_time_formatted"),
        "output_path",
        F.when(F.col("status") == FAILED, crash).otherwise(F.col("message")).alias("message"),
    )


def run_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == SUCCESS).alias("successful"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.count_if(F.col("status") == SKIPPED).alias("skipped"),
    )
