"""Exact ranks and order statistics without putting a whole group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellspark.session import materialize


def _with_bucket_offsets(df: DataFrame, group: list[str], bucket: str) -> DataFrame:
    """Add ``_offset``: how many rows of the group lie in earlier buckets."""
    counts = df.groupBy(*group, bucket).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*group).orderBy(bucket)
    offsets = counts.select(*group, bucket, (F.sum("_n").over(order) - F.col("_n")).alias("_offset"))
    return df.join(offsets, [*group, bucket])


def rank_by_digest(df: DataFrame, group: list[str], digest: str, tie: str, name: str = "rank") -> DataFrame:
    """Exact 1-based rank of each row in its group, in digest order.

    The first two hex digits cut every group into 256 even buckets. Only bucket counts (at most
    256 rows per group) are put in line; rows are sorted within (group, bucket).
    """
    bucketed = df.withColumn("_bucket", F.substring(digest, 1, 2))
    placed = _with_bucket_offsets(bucketed, group, "_bucket")
    within = Window.partitionBy(*group, "_bucket").orderBy(digest, tie)
    ranked = placed.withColumn(name, F.row_number().over(within) + F.col("_offset"))
    return ranked.drop("_bucket", "_offset")


def with_row_index(df: DataFrame, key: str, name: str = "row_idx") -> DataFrame:
    """Number rows 0..n-1 in the order of a unique key.

    Only the keys are spread over the cluster by ranges and stored with the number of their range; each
    range is then numbered by itself and shifted by the sizes of the earlier ones, and the numbers are
    joined back to the rows.
    """
    ranges = df.select(key).repartitionByRange(key).withColumn("_piece", F.spark_partition_id())
    placed = _with_bucket_offsets(materialize(df.sparkSession, ranges, "ranges"), [], "_piece")
    within = Window.partitionBy("_piece").orderBy(key)
    index = (F.row_number().over(within) + F.col("_offset") - 1).cast("bigint")
    return df.join(placed.select(key, index.alias(name)), key).select(*df.columns, name)


def exact_median(df: DataFrame, key: str, value: str, name: str, count_name: str) -> DataFrame:
    """Exact median of ``value`` per key (mean of the two middle values) and the key's row count.

    Equal values are counted first, in the only pass over ``df``. The counts are then lined up in
    steps of a tenth, and only the steps holding a middle row are looked at value by value, so a
    key with a large share of the rows is not collected. Null values are skipped in the median and
    counted in the size.
    """
    counted = materialize(df.sparkSession, df.groupBy(key, value).agg(F.count("*").alias("_n")), "value-counts")
    counted = counted.withColumn("_step", F.floor(F.col(value) * 10))
    by_step = counted.groupBy(key, "_step").agg(F.sum("_n").alias("_n"))
    whole = Window.partitionBy(key)
    valued = F.when(F.col("_step").isNotNull(), F.col("_n"))
    steps = by_step.select(
        key,
        "_step",
        F.sum("_n").over(whole).alias(count_name),
        F.sum(valued).over(whole).alias("_valued"),
        (F.sum(valued).over(whole.orderBy(F.col("_step").asc_nulls_last())) - valued).alias("_before"),
        "_n",
    )
    low, high = F.floor((F.col("_valued") + 1) / 2), F.floor(F.col("_valued") / 2) + 1
    holds_middle = (F.col("_before") < high) & (F.col("_before") + F.col("_n") >= low)
    middle = steps.filter(holds_middle).drop("_n")
    inside = Window.partitionBy(key, "_step").orderBy(value)
    reached = F.col("_before") + F.sum("_n").over(inside)
    # There may be as many counts as rows, however small they are when stored: never broadcast.
    candidates = counted.hint("merge").join(middle, [key, "_step"]).withColumn("_reached", reached)
    is_low = (F.col("_reached") >= low) & (F.col("_reached") - F.col("_n") < low)
    is_high = (F.col("_reached") >= high) & (F.col("_reached") - F.col("_n") < high)
    medians = candidates.groupBy(key).agg(
        ((F.max(F.when(is_low, F.col(value))) + F.max(F.when(is_high, F.col(value)))) / 2).alias(name)
    )
    sizes = counted.groupBy(key).agg(F.sum("_n").alias(count_name))
    return sizes.join(medians, key, "left")
