"""Seeded, partition-independent pseudo-random values made from row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(keys: list[str | Column], seed: int) -> Column:
    """Hex md5 of ``seed:key1:key2``; a null key is written as the text ``null``."""
    parts = [F.lit(str(seed))]
    for key in keys:
        column = F.col(key) if isinstance(key, str) else key
        parts.append(F.coalesce(column.cast("string"), F.lit("null")))
    return F.md5(F.concat_ws(":", *parts))


def digest_number(digest: Column) -> Column:
    """First eight hex digits of a digest as a whole number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_uniform(keys: list[str | Column], seed: int = 42, resolution: int = 10000) -> Column:
    """Uniform number in [0, 1) that depends on the keys and the seed only, never on partitioning."""
    return digest_number(key_digest(keys, seed)) % resolution / F.lit(float(resolution))
