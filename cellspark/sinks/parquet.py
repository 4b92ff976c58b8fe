"""Parquet sinks: codec and level, files by row count or by size, train/test folders."""

from __future__ import annotations

import math
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellspark.session import scratch_path
from cellspark.sources.files import list_files
from cellspark.sources.positions import stored_files, with_positions
from cellspark.sources.tables import read_typed_symbol_table

_PLACE = "_place_in_all_rows"
# Files that are written to measure them, and how far their number may be off.
MEASURED_FILES = 64
MEASURED_SLACK = 1.05

# The most files that a task writes, and those that the driver renames at a time.
TASK_FILES = 64
RENAMES = 16

DEFAULT_CODEC = "zstd"
DEFAULT_LEVEL = 3
# The option that carries a codec's level, for codecs that have levels.
LEVEL_OPTIONS = {
    "zstd": "parquet.compression.codec.zstd.level",
    "gzip": "zlib.compress.level",
    "brotli": "compression.brotli.quality",
}
# What the gzip option calls its levels.
GZIP_LEVELS = {
    1: "BEST_SPEED",
    2: "TWO",
    3: "THREE",
    4: "FOUR",
    5: "FIVE",
    6: "SIX",
    7: "SEVEN",
    8: "EIGHT",
    9: "BEST_COMPRESSION",
}


def _writer(df: DataFrame, codec: str, level: int | None, mode: str) -> DataFrameWriter:
    """``level=None`` is the codec's own default; a level for a codec without levels is an error."""
    writer = df.write.mode(mode).option("compression", codec)
    if level is None or codec not in LEVEL_OPTIONS:
        if level not in (None, DEFAULT_LEVEL):
            raise ValueError(f"{codec} has no compression levels")
        return writer
    if codec == "gzip" and level not in GZIP_LEVELS:
        raise ValueError("gzip levels are 1 to 9")
    return writer.option(LEVEL_OPTIONS[codec], GZIP_LEVELS[level] if codec == "gzip" else str(level))


def write_parquet(
    df: DataFrame, path: str, codec: str = DEFAULT_CODEC, level: int = DEFAULT_LEVEL, mode: str = "errorifexists"
) -> None:
    _writer(df, codec, level, mode).parquet(path)


def write_by_rows(
    df: DataFrame,
    path: str,
    rows_per_file: int,
    codec: str = DEFAULT_CODEC,
    level: int = DEFAULT_LEVEL,
    mode: str = "errorifexists",
) -> None:
    """At most ``rows_per_file`` rows per file; tasks write on their own, nothing is shuffled."""
    _writer(df, codec, level, mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_exact_rows(
    df: DataFrame,
    path: str,
    rows_per_file: int,
    name: str | None = None,
    codec: str = DEFAULT_CODEC,
    level: int = DEFAULT_LEVEL,
    mode: str = "errorifexists",
) -> None:
    """Files of exactly ``rows_per_file`` rows, the last one shorter, however the rows are dealt over tasks.

    Rows are stored once, so that every row has one place whatever is run again, and keep their order; then
    :func:`rechunk`. With ``name`` files are called ``<name>_<start>_<end>.parquet``.
    """
    spark = df.sparkSession
    trial = scratch_path(spark, "exact-rows")
    write_parquet(df, trial, codec, level)
    rechunk(spark, trial, path, rows_per_file, name, codec, level, mode, df.schema)


def rechunk(
    spark: SparkSession,
    folder: str,
    path: str,
    rows_per_file: int,
    name: str | None = None,
    codec: str = DEFAULT_CODEC,
    level: int = DEFAULT_LEVEL,
    mode: str = "errorifexists",
    schema: StructType | None = None,
) -> None:
    """Stored rows again, in the same order, as files of exactly ``rows_per_file`` rows but for the last.

    A row's position says in which file it goes. A task takes as many whole files as its share of the input asks
    for, so rows move once, but at most TASK_FILES: small files cost their number, not their rows, and few long tasks
    would leave cores idle at the end.
    """
    if rows_per_file < 1:
        raise ValueError("a file holds one row at least")
    files = stored_files(spark, folder)
    total = files[-1].end if files else 0
    if not total:
        rows = spark.read.parquet(folder) if schema is None else spark.read.schema(schema).parquet(folder)
        _writer(rows.limit(0), codec, level, mode).parquet(path)
        return
    placed = with_positions(spark, folder, _PLACE, files=files)
    chunks = math.ceil(total / rows_per_file)
    per_task = min(TASK_FILES, math.ceil(chunks / min(chunks, spark.read.parquet(folder).rdd.getNumPartitions())))
    task = F.floor(F.col(_PLACE) / (per_task * rows_per_file)).cast("int")
    dealt = placed.repartitionById(math.ceil(chunks / per_task), task).sortWithinPartitions(_PLACE).drop(_PLACE)
    _writer(dealt, codec, level, mode).option("maxRecordsPerFile", rows_per_file).parquet(path)
    if name is not None:
        _name_by_rows(spark, path, name, per_task, rows_per_file, total)


def _name_by_rows(spark: SparkSession, path: str, name: str, per_task: int, rows_per_file: int, total: int) -> None:
    """Rename files as written (``part-<task>-...-c<number>...``) after the rows they hold, several at a time."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = (status.getPath().getName() for status in system.listStatus(folder))
    # Names differ only in their numbers, so one is enough: asking for all of them takes longer than to rename them.
    middle, end = next(found.groups() for found in (re.fullmatch(r"part-\d+(-.*-c)\d+(\..*parquet)", n) for n in names) if found)

    def rename(start: int) -> None:
        task, number = divmod(start // rows_per_file, per_task)
        source = hadoop.Path(folder, f"part-{task:05d}{middle}{number:03d}{end}")
        target = hadoop.Path(folder, f"{name}_{start:07d}_{min(start + rows_per_file, total):07d}.parquet")
        if not system.rename(source, target):
            raise OSError(f"{source} could not be renamed to {target}")

    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(rename, range(0, total, rows_per_file)))


def write_by_size(
    df: DataFrame,
    path: str,
    target_mb: float,
    codec: str = DEFAULT_CODEC,
    level: int = DEFAULT_LEVEL,
    mode: str = "errorifexists",
) -> None:
    """Files of about ``target_mb``, none much larger and, but for one file in all, none under half of it.

    The rows are first written to the shared folder with the same codec, in few large files, which runs the input plan
    only once; they are then dealt evenly over as many files as their size asks for. A row takes more room in a small
    file (its dictionaries and its footer serve fewer rows), so up to MEASURED_FILES files, with the rows they would be
    dealt, are written beside and measured until their number is right.
    """
    spark = df.sparkSession
    trial = scratch_path(spark, "by-size")
    write_parquet(df.hint("rebalance"), trial, codec, level)
    stored = spark.read.schema(df.schema).parquet(trial)
    rows, target, before = stored.count(), target_mb * 1024 * 1024, math.inf
    files = max(1, math.ceil(_written_bytes(spark, trial) / target))
    while files < rows:
        measured = min(files, MEASURED_FILES)
        dealt = stored.withColumn(_PLACE, F.monotonically_increasing_id() % files).where(F.col(_PLACE) < measured)
        beside = scratch_path(spark, "measured")
        write_parquet(dealt.repartitionById(measured, F.col(_PLACE).cast("int")).drop(_PLACE), beside, codec, level)
        mean = _written_bytes(spark, beside) / measured
        # Where little but the footer is left in a file, more files make none of them smaller.
        if mean <= target * MEASURED_SLACK or mean > before * 0.95:
            break
        files, before = min(math.ceil(files * mean / target), rows), mean
    write_parquet(stored.repartition(files), path, codec, level, mode)


def _written_bytes(spark: SparkSession, path: str) -> int:
    return list_files(spark, path, "*.parquet").agg(F.sum("length").alias("n")).first()["n"] or 0


def write_chunks(
    df: DataFrame, path: str, chunk_size: int | None = None, target_mb: float | None = None, exact: bool = False, **options
) -> None:
    """Chunked write; a target size wins over a row count, as both may be given.

    ``chunk_size`` is the most a file holds and costs no shuffle; ``exact`` makes it what every file but the last holds.
    """
    if target_mb is not None:
        write_by_size(df, path, target_mb, **options)
    elif chunk_size is not None and exact:
        write_exact_rows(df, path, chunk_size, **options)
    elif chunk_size is not None:
        write_by_rows(df, path, chunk_size, **options)
    else:
        write_parquet(df, path, **options)


def write_split(df: DataFrame, path: str, dataset: str, chunk_size: int | None = None, **options) -> None:
    """One dataset in one job, as ``<path>/<dataset>/split=train`` and ``/split=test``."""
    writer = _writer(
        df.hint("rebalance", "split"),
        options.get("codec", DEFAULT_CODEC),
        options.get("level", DEFAULT_LEVEL),
        options.get("mode", "errorifexists"),
    )
    if chunk_size is not None:
        writer = writer.option("maxRecordsPerFile", chunk_size)
    writer.partitionBy("split").parquet(f"{path}/{dataset}")


def write_exact_split(df: DataFrame, path: str, dataset: str, chunk_size: int, **options) -> None:
    """One dataset as ``<path>/<dataset>/split=train`` and ``/split=test``, each in files
    ``<dataset>_<start>_<end>.parquet`` of exactly ``chunk_size`` rows but for the last."""
    spark = df.sparkSession
    trial = scratch_path(spark, "exact-split")
    df.write.partitionBy("split").parquet(trial)
    sides = [r["split"] for r in spark.read.parquet(trial).select("split").distinct().collect()]
    for side in sides:
        rechunk(spark, f"{trial}/split={side}", f"{path}/{dataset}/split={side}", chunk_size, dataset, **options)


def write_all_splits(
    df: DataFrame,
    path: str,
    chunk_size: int | None = None,
    mode: str = "errorifexists",
    clustered: bool = False,
) -> None:
    """All datasets in one job, as ``dataset_id=.../split=...`` folders.

    The rebalance hint brings rows of one folder together and lets AQE cut a large folder into
    several tasks and merge small ones, so neither one huge task nor many tiny files result. Not
    needed for rows that are already ``clustered`` (see ``BuildOptions.cluster_output``).
    """
    rows = df if clustered else df.hint("rebalance", "dataset_id", "split")
    writer = _writer(rows, DEFAULT_CODEC, DEFAULT_LEVEL, mode)
    if chunk_size is not None:
        writer = writer.option("maxRecordsPerFile", chunk_size)
    writer.partitionBy("dataset_id", "split").parquet(path)


def write_by_cell(df: DataFrame, table: str, path: str, buckets: int, keys: tuple[str, ...] = ("dataset_id", "cell_id"), mode: str = "errorifexists") -> DataFrame:
    """A catalog table in ``buckets`` hash buckets by cell, sorted within them.

    Long expression stored so becomes array form, and meets other tables in the same buckets, without a shuffle.
    Rows are dealt by the same hash first, so every bucket is one file.
    """
    writer = _writer(df.repartition(buckets, *keys), DEFAULT_CODEC, DEFAULT_LEVEL, mode)
    writer.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def symbol_table_to_parquet(spark: SparkSession, tsv: str, path: str) -> None:
    write_parquet(read_typed_symbol_table(spark, tsv), path)
