"""Equi-join helpers that stay even when one key holds a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.session import materialize

# At most HOT_SHARE keys can each hold 1/HOT_SHARE of the rows, so the hot side of a
# lookup that is unique per key never has more than HOT_SHARE rows.
HOT_SHARE = 1000
BROADCAST_ROWS = 200_000
# Facts that one copy of a wide lookup row should meet, and the most copies in all.
ROWS_PER_COPY = 20_000
MAX_COPIES = 100_000
# Rows of a task that groups or sorts them, and how few are worth a task where cores would be idle.
ROWS_PER_TASK = 250_000
LEAST_ROWS_PER_TASK = 20_000
# Groups that a task needs, on average, to get about as many rows as the others where groups stay whole.
GROUPS_PER_TASK = 8


def deal_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a stored table dealt by ``keys`` over as many tasks as their number asks for.

    What is grouped or ranked by these keys, or by more columns, needs no further shuffle, and a task's memory does not
    grow with the table. Planned by bytes, many narrow rows, or rows that pack well, would come to one task. The number
    of rows is read from the footers.
    """
    return rows.repartition(_tasks(rows, rows.count()), *keys)


def _tasks(rows: DataFrame, count: int) -> int:
    few = min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(count / LEAST_ROWS_PER_TASK))
    # Never one: a single task would need no shuffle, and what is cut before one would not be.
    return max(2, few, math.ceil(count / ROWS_PER_TASK))


def deal_groups(rows: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """As :func:`deal_rows`, but by ``group`` alone where its values are many and each has few of the rows, which is counted.

    Texts made of the rows of a group are much alike, and take a fraction of the room in a file that holds them side by
    side. Where a group is too large for a task, or there are too few of them to be dealt evenly, rows go by ``keys``.
    """
    found = rows.groupBy(group).agg(F.count("*").alias("n"))
    found = found.agg(F.sum("n").alias("rows"), F.count("*").alias("groups"), F.max("n").alias("most")).first()
    tasks = _tasks(rows, found["rows"] or 0)
    whole = found["groups"] >= GROUPS_PER_TASK * tasks and found["most"] <= ROWS_PER_TASK
    return rows.repartition(tasks, *([group] if whole else keys))


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join a fact table with a lookup table.

    No broadcast hint: the planner broadcasts a lookup whose size it knows to be under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE checks the real size again at run time). Beyond
    it the join is a shuffled one, where AQE splits skewed key partitions.
    """
    return facts.join(lookup, keys, how)


def spread_join(
    facts: DataFrame, lookup: DataFrame, key: str, spread_by: list[str], size: int, broadcast_size: int
) -> DataFrame:
    """Left join with few, wide lookup rows (one per key), where one key may hold most facts.

    ``size`` is the counted size of the lookup: up to ``broadcast_size`` it is broadcast and the
    facts do not move. Beyond that, a key with many facts gets as many copies of its lookup row as
    it needs for every copy to meet a bounded number of facts; ``spread_by`` names fact columns
    that differ between the rows of a key.
    """
    if size <= broadcast_size:
        return facts.join(F.broadcast(lookup), key, "left")
    sizes = materialize(facts.sparkSession, facts.groupBy(key).agg(F.count("*").alias("_n")), "key-sizes")
    total = sizes.agg(F.sum("_n").alias("n")).first()["n"] or 0
    # Keys with more than one copy: fewer than MAX_COPIES rows, so they can be broadcast.
    per_copy = max(ROWS_PER_COPY, total // MAX_COPIES)
    copies = sizes.select(key, F.ceil(F.col("_n") / per_copy).cast("int").alias("_copies")).filter("_copies > 1")
    n_copies = F.coalesce("_copies", F.lit(1))
    salted = facts.join(F.broadcast(copies), key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), n_copies).cast("int")
    )
    copied = lookup.join(F.broadcast(copies), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), n_copies - 1))
    )
    return salted.drop("_copies").join(copied.drop("_copies"), [key, "_salt"], "left").drop("_salt")


def hot_key_join(facts: DataFrame, lookup: DataFrame, key: str, rows_per_key: str) -> DataFrame:
    """Inner join with a stored lookup that is unique per key and knows its number of fact rows.

    Up to BROADCAST_ROWS narrow rows are broadcast after counting them. Beyond that, keys holding
    at least 1/HOT_SHARE of the rows (there are at most HOT_SHARE of them, whatever the data size)
    are joined by broadcast and taken out of the shuffled join of all other keys.
    """
    sizes = lookup.agg(F.count("*").alias("keys"), F.sum(rows_per_key).alias("rows")).first()
    if sizes["keys"] <= BROADCAST_ROWS:
        return facts.join(F.broadcast(lookup), key)
    hot = F.col(rows_per_key) * HOT_SHARE >= F.lit(sizes["rows"])
    hot_lookup = F.broadcast(lookup.filter(hot))
    others = facts.join(F.broadcast(lookup.filter(hot).select(key)), key, "left_anti")
    return facts.join(hot_lookup, key).unionByName(others.join(lookup.filter(~hot), key))
