"""Incremental ingest: new files only, with donors that never change sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cellspark.operators.splits import split_donors_by_hash
from cellspark.session import materialize

BATCH = "batch_id"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    donor: str = "donor_id",
    test_size: float = 0.05,
    seed: int = 42,
    pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> None:
    """Process the files not seen yet, then stop; run it again for later files.

    The side of a donor follows from its key alone, so it depends neither on the order in which files
    arrive nor on how many make up a batch, and no state has to be kept or joined. Each batch goes to
    ``<target>/cells/batch_id=<n>``, replaced on a replay, so a batch that is run again after a failure
    leaves its rows once.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The planner takes a batch for tiny, whatever it holds, and stored rows with equal values for small ones; a batch
        # is never to be broadcast, so joins with it are sorted ones unless the other side asks for a broadcast.
        rows = materialize(spark, batch, "new-rows").hint("merge")
        split = split_donors_by_hash(transform(rows), donor, test_size, seed)
        split.write.mode("overwrite").parquet(f"{target}/cells/{BATCH}={batch_id}")

    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/cells").drop(BATCH)
