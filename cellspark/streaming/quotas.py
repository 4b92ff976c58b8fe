"""Incremental ingest with test quotas per age stratum over all donors seen so far.

Donors keep the side they got at first sight, so sides are state. A donor is placed by the first file that holds it: its
stratum is its rounded median age there, and the k-th donor of a stratum, in order of files and then of a hash, is a
test donor where ``floor(k * share + offset)`` steps up. After every file each stratum has its share of test donors to
within one, and nothing depends on how files make up batches.

Each batch writes its new donors to ``<target>/donors/batch_id=<n>`` and its cells to ``<target>/cells/batch_id=<n>``,
and looks only at donors of earlier batches, which are joined by a shuffle as their number has no bound; so a batch that is run again finds what it found before, and replaces its
folders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.functions.hashing import digest_number, key_digest
from cellspark.functions.text import MISSING_TEXT
from cellspark.operators.ranking import exact_median, rank_by_digest
from cellspark.operators.splits import TEST, TRAIN, with_donor_key
from cellspark.session import materialize

ARRIVAL = "arrival"
BATCH = "batch_id"
# Shares are whole ten-thousandths, so that steps are the same in every engine.
STEPS = 10_000
STATE_SCHEMA = "donor string, stratum string, place bigint, split string, batch_id bigint"


def arrival() -> Column:
    """What files are put in order by: time of modification, then path."""
    return F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"))


def stratum_of(age: Column) -> Column:
    return F.coalesce((F.rint(age * 10) / 10).cast("string"), F.lit(MISSING_TEXT))


def side_of_place(stratum: str, place: str, test_size: float, seed: int) -> Column:
    """``test`` where the share of a stratum's first ``place`` donors steps up."""
    share = F.lit(round(test_size * STEPS)).cast("bigint")
    reached = F.col(place) * share + digest_number(key_digest([stratum], seed)) % STEPS
    return F.when(F.floor(reached / STEPS) > F.floor((reached - share) / STEPS), TEST).otherwise(TRAIN)


def place_new_donors(cells: DataFrame, known: DataFrame, donor: str, age: str, test_size: float, seed: int) -> DataFrame:
    """Donors of ``cells`` that are not in ``known`` (``donor, stratum, place, ...``), with stratum, place and side.

    ``cells`` hold :data:`ARRIVAL` and are stored, as they are read several times.
    """
    spark = cells.sparkSession
    keyed = cells.select(F.col(donor).alias("donor"), F.col(age).alias("_age"), ARRIVAL)
    first = keyed.groupBy("donor").agg(F.min(ARRIVAL).alias("_first")).join(known.select("donor").hint("merge"), "donor", "left_anti")
    # Cells of a donor with many are joined by key; the planner splits them.
    at_first = keyed.hint("merge").join(first, "donor").where(F.col(ARRIVAL) == F.col("_first"))
    ages = exact_median(at_first, "donor", "_age", "_median", "_cells")
    new = first.join(ages, "donor").select("donor", "_first", stratum_of(F.col("_median")).alias("stratum"), key_digest(["donor"], seed).alias("_digest"))
    new = materialize(spark, new, "new-donors")
    ranked = rank_by_digest(new, ["stratum", "_first"], "_digest", "donor", "_rank")
    # One row per stratum and file is put in line.
    by_file = new.groupBy("stratum", "_first").agg(F.count("*").alias("_n"))
    in_line = Window.partitionBy("stratum").orderBy("_first")
    earlier = by_file.select("stratum", "_first", (F.sum("_n").over(in_line) - F.col("_n")).alias("_earlier"))
    taken = known.groupBy("stratum").agg(F.max("place").alias("_taken"))
    placed = ranked.join(earlier, ["stratum", "_first"]).join(taken, "stratum", "left")
    place = F.col("_rank") + F.col("_earlier") + F.coalesce("_taken", F.lit(0))
    placed = placed.select("donor", "stratum", place.cast("bigint").alias("place"))
    return placed.withColumn("split", side_of_place("stratum", "place", test_size, seed))


def ingest_with_quotas(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    donor: str = "donor_id",
    age: str = "age",
    test_size: float = 0.05,
    seed: int = 42,
    pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> None:
    """Process the files not seen yet, then stop; run it again for later files.

    ``transform`` gets the rows of new files with a column :data:`ARRIVAL` and has to keep it.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The planner takes a batch for tiny, whatever it holds, and stored rows with equal values for small ones; a batch
        # is never to be broadcast, so joins with it are sorted ones unless the other side asks for a broadcast.
        rows = materialize(spark, batch, "new-rows").hint("merge")
        cells = materialize(spark, with_donor_key(transform(rows), donor), "ingested")
        known = read_donor_sides(spark, target, before=batch_id)
        new = place_new_donors(cells, known, donor, age, test_size, seed)
        new.write.mode("overwrite").parquet(f"{target}/donors/{BATCH}={batch_id}")
        sides = read_donor_sides(spark, target, before=batch_id + 1).select(F.col("donor").alias(donor), "split")
        cells.drop(ARRIVAL).join(sides.hint("merge"), donor).write.mode("overwrite").parquet(f"{target}/cells/{BATCH}={batch_id}")

    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .select("*", arrival().alias(ARRIVAL))
    )
    query = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_donor_sides(spark: SparkSession, target: str, before: int | None = None) -> DataFrame:
    """``donor, stratum, place, split, batch_id`` of all donors, or of those placed in batches before one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/donors")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], STATE_SCHEMA)
    state = spark.read.schema(STATE_SCHEMA).parquet(f"{target}/donors")
    return state if before is None else state.where(F.col(BATCH) < before)
