"""What several of the text operators share: inputs, words, stored tables, sums over partitions, components."""

from __future__ import annotations

import functools
import math
import os
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import cellspark
from cellspark.session import materialize

# Fixed value: white space that separates words, as a character class body for Java's expressions.
BLANKS = r"\x20\x09-\x0D"


@functools.cache
def _shipped(application: str) -> str:
    folder = tempfile.mkdtemp(prefix="cellspark-code-")
    path = os.path.join(folder, "cellspark-code.zip")
    package = Path(cellspark.__file__).parent
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    SparkContext.getOrCreate().addPyFile(path)
    return path


def ship(spark: SparkSession) -> None:
    """Let Spark send this package to the Python workers of the application, once."""
    _shipped(spark.sparkContext.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(key: Column | str, parts: int) -> Column:
    """crc32 of a key written as text, modulo ``parts``; null for a null key."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % parts


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table written to the shared folder and read back: cut lineage that survives a lost executor."""
    return materialize(df.sparkSession, df, name)


def smallest_hashes(rows: DataFrame, label: str, most: int) -> DataFrame:
    """Of each ``label`` the ``most`` rows with the smallest hashes of ``doc_id``, and the ``weight`` with which each stands
    for all rows of its label. Sizes of labels are broadcast; only about as many rows as are kept are put in line."""
    sizes = rows.groupBy(label).agg(F.count("*").alias("size"))
    number = F.xxhash64("doc_id")
    # Numbers are even, so few rows beyond the wanted ones lie under this bound, and practically never fewer.
    near = rows.join(F.broadcast(sizes), label).where((number / F.lit(2.0**64) + 0.5) * F.col("size") <= most + 8 * math.sqrt(most) + 32)
    place = F.row_number().over(Window.partitionBy(label).orderBy(number, "doc_id"))
    weight = F.greatest(F.lit(1.0), F.col("size") / F.lit(float(most)))
    return near.withColumn("place", place).where(F.col("place") <= most).select("doc_id", label, weight.alias("weight"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that what is made of them stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def text_slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        stop = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, side="right")))
        yield batch.slice(first, stop - first)
        first = stop


def packed_vector(values: np.ndarray) -> bytes:
    return zlib.compress(np.asarray(values, "<i8").tobytes(), 1)


def sum_vectors(df: DataFrame, column: str) -> np.ndarray | None:
    """The sum of a column of packed vectors of one length, in two steps of tasks; None where there are none.

    One vector per task and step travels, so what reaches the driver does not grow with the rows.
    """

    def together(batches):
        total = None
        for batch in batches:
            for part in batch.column(0):
                values = np.frombuffer(zlib.decompress(part.as_py()), "<i8")
                total = values.copy() if total is None else np.add(total, values, out=total)
        if total is not None:
            yield pa.RecordBatch.from_pydict({column: pa.array([packed_vector(total)], pa.binary())})

    vectors = df.where(F.col(column).isNotNull()).select(column)
    between = math.ceil(math.sqrt(max(1, vectors.rdd.getNumPartitions())))
    kind = f"{column} binary"
    merged = vectors.mapInArrow(together, kind).repartition(between).mapInArrow(together, kind)
    rows = merged.repartition(1).mapInArrow(together, kind).collect()
    return np.frombuffer(zlib.decompress(rows[0][0]), "<i8") if rows else None


def sum_over_partitions(df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], merge=np.add) -> np.ndarray | None:
    """Merge one uint32 array of fixed size per partition, in two steps of tasks; None without partitions.

    Only arrays of that one size travel, packed, so what reaches the driver does not grow with the rows.
    """

    def packed(values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array([zlib.compress(values.tobytes(), 1)], pa.binary())})

    def one(batches):
        yield packed(count(batches))

    def together(batches):
        total = None
        for batch in batches:
            for part in batch.column("part"):
                values = np.frombuffer(zlib.decompress(part.as_py()), np.uint32)
                total = values.copy() if total is None else merge(total, values, out=total)
        if total is not None:
            yield packed(total)

    between = math.ceil(math.sqrt(max(1, df.rdd.getNumPartitions())))
    merged = df.mapInArrow(one, "part binary").repartition(between).mapInArrow(together, "part binary")
    rows = merged.repartition(1).mapInArrow(together, "part binary").collect()
    return np.frombuffer(zlib.decompress(rows[0][0]), np.uint32) if rows else None


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``) of every node on an edge (``u``, ``v``): the smallest node it reaches.

    Alternating star operations: every node hands its larger neighbours, then its smaller ones, to the
    smallest node it knows. The number of edges never grows, and each round is written to the shared folder.
    """
    edges = stored(_descending(edges), "edges")
    print_before = None
    while True:
        fingerprint = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if fingerprint == print_before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
        print_before = fingerprint
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A node that has no smaller neighbour keeps itself as the centre, which "m" already holds.
        large = _descending(large)
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small, "u")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        edges = stored(_descending(moved), "edges")


def _descending(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def any_of(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))
