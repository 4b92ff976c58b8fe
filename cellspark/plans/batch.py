"""Batches of datasets: what to run, running with failures kept apart, the report."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.operators.inventory import (
    EXISTS_MESSAGE,
    FAILED,
    SKIPPED,
    SUCCESS,
    finished_datasets,
    run_report,
    size_message,
    with_dataset_name,
    within_size,
)

RESULT_SCHEMA = "dataset_name string, status string, seconds double, output_path string, message string"


def plan_batch(
    files: DataFrame, outputs: DataFrame | None, limit_mb: float | None = None, skip_split: bool = False
) -> DataFrame:
    """Input files with ``action``: ``run``, or ``skip`` with the reason."""
    named = with_dataset_name(files)
    if outputs is None:
        done = named.withColumn("_done", F.lit(False))
    else:
        finished = finished_datasets(outputs, skip_split).withColumn("_done", F.lit(True))
        done = named.join(finished, "dataset_name", "left")
    reason = (
        F.when(~within_size(limit_mb), size_message(limit_mb))
        .when(F.coalesce("_done", F.lit(False)), F.lit(EXISTS_MESSAGE))
    )
    return done.withColumn("message", reason).withColumn(
        "action", F.when(F.col("message").isNull(), "run").otherwise("skip")
    ).drop("_done")


def pending_rows(df: DataFrame, planned: DataFrame) -> DataFrame:
    """Rows of the datasets that are to be run, of any table with a ``dataset_id``."""
    to_run = planned.filter(F.col("action") == "run").select(F.col("dataset_name").alias("dataset_id"))
    return df.join(to_run, "dataset_id", "left_semi")


def batch_report(
    planned: DataFrame, built: DataFrame, filtered: DataFrame | None = None, broken: DataFrame | None = None
) -> DataFrame:
    """Status and number of cells of every planned dataset, from the rows of one build of them all.

    A dataset that was to run and has no rows failed, unless it is in ``filtered`` (``dataset_id``): there
    all of its cells were rightly left out. Datasets in ``broken`` (``dataset_name, message``, see
    :func:`cellspark.plans.isolation.broken_datasets`) failed with that message.
    """
    cells = built.groupBy(F.col("dataset_id").alias("dataset_name")).agg(F.count("*").alias("cells"))
    done = planned.select("dataset_name", "action", "message").join(cells, "dataset_name", "left")
    if filtered is None:
        emptied = F.lit(False)
    else:
        names = filtered.select(F.col("dataset_id").alias("dataset_name")).distinct().withColumn("_emptied", F.lit(True))
        done = done.join(names, "dataset_name", "left")
        emptied = F.coalesce("_emptied", F.lit(False))
    if broken is not None:
        done = done.join(broken.select("dataset_name", F.col("message").alias("_broken")), "dataset_name", "left")
    why = F.lit(None).cast("string") if broken is None else F.col("_broken")
    status = F.when(F.col("action") != "run", SKIPPED).when(why.isNotNull(), FAILED).when(F.col("cells").isNotNull() | emptied, SUCCESS).otherwise(FAILED)
    message = F.when(status == SKIPPED, F.col("message")).when(status == FAILED, F.coalesce(why, F.lit("No rows were built"))).otherwise("Successfully processed")
    return done.select("dataset_name", status.alias("status"), F.coalesce("cells", F.lit(0)).alias("cells"), message.alias("message"))


def run_batch(
    spark: SparkSession, datasets: Iterable[str], process: Callable[[str], str], skipped: DataFrame | None = None
) -> DataFrame:
    """Run ``process(dataset) -> output path`` for each dataset; a failing one does not stop the rest.

    For inputs that may be broken one by one. Sound inputs are better built together, with the
    dataset as a column: :func:`pending_rows`, ``build_dataset`` and :func:`batch_report`.
    """
    results = []
    for dataset in datasets:
        started = time.monotonic()
        try:
            path, status, message = process(dataset), SUCCESS, "Successfully processed"
        except Exception as error:  # noqa: BLE001 - the report names every failure
            path, status, message = "", FAILED, str(error).splitlines()[0] if str(error) else type(error).__name__
        results.append((dataset, status, time.monotonic() - started, path, message))
    table = spark.createDataFrame(results, RESULT_SCHEMA)
    if skipped is not None:
        table = skipped.select(
            "dataset_name",
            F.lit(SKIPPED).alias("status"),
            F.lit(0.0).alias("seconds"),
            F.lit("").alias("output_path"),
            "message",
        ).unionByName(table)
    return run_report(table)
