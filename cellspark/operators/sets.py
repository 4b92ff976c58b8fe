"""Unions across differing schemas and set comparisons of keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def concat(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, same columns."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def diagonal_concat(*frames: DataFrame) -> DataFrame:
    """Rows of all frames over the union of their columns.

    A column missing in a frame is null there. Numeric types widen; a column that is text in one
    frame and something else in another becomes text.
    """
    kinds: dict[str, set[type]] = {}
    for frame in frames:
        for field in frame.schema:
            kinds.setdefault(field.name, set()).add(type(field.dataType))
    as_text = [n for n, found in kinds.items() if T.StringType in found and len(found) > 1]

    def aligned(frame: DataFrame) -> DataFrame:
        casts = {n: F.col(n).cast("string") for n in as_text if n in frame.columns}
        return frame.withColumns(casts) if casts else frame

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(aligned, frames))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def lost_keys(whole: DataFrame, key: str, *parts: DataFrame) -> DataFrame:
    """Keys of ``whole`` that are in none of the parts."""
    return whole.select(key).subtract(concat(*[p.select(key) for p in parts]))
