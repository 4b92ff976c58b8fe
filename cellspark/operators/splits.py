"""Train/test splits by cell or by donor, and their checks.

Random numbers are hashes of row keys, so a split does not depend on partitioning, and a retried
task gives the same rows.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.functions.hashing import digest_number, hash_uniform, key_digest
from cellspark.functions.text import MISSING_TEXT, percent, ratio
from cellspark.operators.columns import DONOR_COLUMNS, first_present
from cellspark.operators.joins import BROADCAST_ROWS, hot_key_join
from cellspark.operators.ranking import exact_median, rank_by_digest
from cellspark.session import materialize

TRAIN, TEST = "train", "test"
WHOLE = "all"


def split_label(uniform: Column, test_size: float) -> Column:
    return F.when(uniform < test_size, TEST).otherwise(TRAIN)


def split_cells(df: DataFrame, cell: list[str], test_size: float = 0.05, seed: int = 42) -> DataFrame:
    """Cell-level random split."""
    return df.withColumn("split", split_label(hash_uniform(list(cell), seed), test_size))


def split_cells_by_age(
    df: DataFrame, cell: list[str], age: str = "age", test_size: float = 0.05, seed: int = 42
) -> DataFrame:
    """Cell-level split with a threshold per age group: the age takes part in the hash.

    The age enters as whole thousandths, so that its text is the same in every engine.
    """
    key = F.round(F.col(age) * 1000).cast("bigint")
    return df.withColumn("split", split_label(hash_uniform([key, *cell], seed), test_size))


def with_donor_key(df: DataFrame, donor: str) -> DataFrame:
    """A missing donor counts as one donor of its own, so that its cells are not lost."""
    return df.withColumn(donor, F.coalesce(F.col(donor).cast("string"), F.lit(MISSING_TEXT)))


def split_donors_by_hash(df: DataFrame, donor: str, test_size: float = 0.05, seed: int = 42) -> DataFrame:
    """Donor-level random split. The side follows from the donor key alone: no shuffle, no join."""
    return with_donor_key(df, donor).withColumn("split", split_label(hash_uniform([donor], seed), test_size))


def donor_ages(df: DataFrame, donor: str, age: str = "age") -> DataFrame:
    """``(donor, cells, donor_age)`` with the exact median age."""
    return exact_median(df, donor, age, "donor_age", "cells")


def donor_age_split(
    df: DataFrame, donor: str, age: str = "age", test_size: float = 0.05, seed: int = 42
) -> DataFrame:
    """Donor table with a side per donor: threshold on a hash of the donor's median age and key."""
    donors = donor_ages(df, donor, age)
    key = F.round(F.col("donor_age") * 1000).cast("bigint")
    return donors.withColumn("split", split_label(hash_uniform([key, donor], seed), test_size))


def _place_quotas(strata: DataFrame, n_donors: int, n_test: int, seed: int) -> DataFrame:
    """``(stratum, quota)``: whole shares of the test places, then one more by largest remainder.

    Strata with the same remainder form a class. Only classes are put in one line: strata of equal
    size have equal remainders, so there are at most about sqrt(2 x donors) of them. Within the
    class that gets only some of the places left, strata are ranked by hash.
    """
    exact = F.col("donors") * F.lit(n_test).cast("bigint")
    shares = strata.select(
        "stratum",
        F.floor(exact / n_donors).alias("_base"),
        (exact % n_donors).alias("_remainder"),
        key_digest(["stratum"], seed).alias("_digest"),
    )
    left_over = shares.agg((F.lit(n_test) - F.sum("_base")).alias("n")).select("n").scalar()
    classes = shares.groupBy("_remainder").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy(F.col("_remainder").desc())) - F.col("_size")
    places = classes.select("_remainder", (left_over - before).alias("_places"))
    ranked = rank_by_digest(shares, ["_remainder"], "_digest", "stratum", "_rank")
    ranked = ranked.join(F.broadcast(places), "_remainder")
    extra = (F.col("_rank") <= F.col("_places")) & (F.col("_remainder") > 0)
    return ranked.select("stratum", (F.col("_base") + extra.cast("int")).alias("quota"))


def quota_split(donors: DataFrame, donor: str, test_size: float = 0.05, seed: int = 42) -> DataFrame:
    """Donor table with a side per donor, with exact test quotas per rounded median age.

    ``donors`` comes from :func:`donor_ages`, materialised (it is read several times). As with a
    stratified shuffle split, the strata are dropped when one has a single donor or when a side
    has fewer places than there are strata; a warning says so, and ``stratum`` is then the same for all.
    One lone donor stays in train.
    """
    text = F.coalesce((F.rint(F.col("donor_age") * 10) / 10).cast("string"), F.lit(MISSING_TEXT))
    keyed = donors.withColumn("stratum", text).withColumn("_donor_digest", key_digest([donor], seed))
    strata = keyed.groupBy("stratum").agg(F.count("*").alias("donors"))
    sizes = strata.agg(F.sum("donors").alias("n"), F.count("*").alias("strata"), F.min("donors").alias("least")).first()
    n_donors = sizes["n"] or 0
    n_test = math.ceil(test_size * n_donors) if n_donors > 1 else 0
    if sizes["strata"] > min(n_test, n_donors - n_test) or (sizes["least"] or 0) < 2:
        if n_donors > 1:
            warnings.warn(f"{sizes['strata']} age strata for {n_test} test donors: split without strata", stacklevel=2)
        whole = keyed.withColumn("stratum", F.lit(WHOLE))
        ranked = rank_by_digest(whole, [], "_donor_digest", donor).withColumn("quota", F.lit(n_test))
    else:
        quotas = _place_quotas(strata, n_donors, n_test, seed)
        quotas = F.broadcast(quotas) if sizes["strata"] <= BROADCAST_ROWS else quotas
        ranked = rank_by_digest(keyed, ["stratum"], "_donor_digest", donor).join(quotas, "stratum")
    side = F.when(F.col("rank") <= F.col("quota"), TEST).otherwise(TRAIN)
    return ranked.withColumn("split", side).select(*donors.columns, "stratum", "split")


def join_split(df: DataFrame, donor_splits: DataFrame, donor: str) -> DataFrame:
    """Attach each donor's side to its cells. ``donor_splits`` holds (donor, cells, split), materialised."""
    return hot_key_join(df, donor_splits.select(donor, "cells", "split"), donor, "cells").drop("cells")


def split_donors_by_quota(
    df: DataFrame, donor: str, age: str = "age", test_size: float = 0.05, seed: int = 42
) -> DataFrame:
    """Donor-level stratified split with exact quotas; all cells of a donor on one side."""
    spark = df.sparkSession
    keyed = with_donor_key(df, donor)
    donors = materialize(spark, donor_ages(keyed, donor, age), "donor_ages")
    sides = materialize(spark, quota_split(donors, donor, test_size, seed), "donor_split")
    return join_split(keyed, sides, donor)


def split_donors_by_age(
    df: DataFrame, donor: str, age: str = "age", test_size: float = 0.05, seed: int = 42
) -> DataFrame:
    """Donor-level split by a threshold that depends on the donor's median age and key."""
    spark = df.sparkSession
    keyed = with_donor_key(df, donor)
    sides = materialize(spark, donor_age_split(keyed, donor, age, test_size, seed), "donor_split")
    return join_split(keyed, sides, donor)


def split_dataset(
    df: DataFrame,
    cell: list[str],
    age: str = "age",
    test_size: float = 0.05,
    seed: int = 42,
    stratify_by_age: bool = True,
) -> DataFrame:
    """Split by donor where a donor column exists, else by cell."""
    donor = first_present(df, DONOR_COLUMNS)
    if donor is not None:
        if stratify_by_age:
            return split_donors_by_quota(df, donor, age, test_size, seed)
        return split_donors_by_hash(df, donor, test_size, seed)
    if stratify_by_age:
        return split_cells_by_age(df, cell, age, test_size, seed)
    return split_cells(df, cell, test_size, seed)


def split_cells_by_row(
    df: DataFrame, row: str, age: str = "age", test_size: float = 0.05, seed: int = 42
) -> DataFrame:
    """Cell-level hash split: the hash of the age plus the hash of the row key."""
    age_key = F.round(F.col(age) * 1000).cast("bigint")
    total = digest_number(key_digest([age_key], seed)) + digest_number(key_digest([row], seed + 1))
    return df.withColumn("split", split_label(total % 10000 / 10000.0, test_size))


def donor_statistics(df: DataFrame, donor: str) -> DataFrame:
    """Donors, cells and mean cells per donor."""
    per_donor = df.groupBy(donor).agg(F.count("*").alias("cells"))
    return per_donor.agg(
        F.count("*").alias("total_donors"),
        F.coalesce(F.sum("cells"), F.lit(0)).alias("total_cells"),
        ratio(F.sum("cells"), F.count("*"), 2).alias("avg_cells_per_donor"),
    )


def split_statistics(df: DataFrame) -> DataFrame:
    """Cells per side, percentages and the real test share."""
    total = F.count("*")
    train, test = F.count_if(F.col("split") == TRAIN), F.count_if(F.col("split") == TEST)
    return df.agg(
        total.alias("total_cells"),
        train.alias("train_cells"),
        test.alias("test_cells"),
        percent(train, total).alias("train_pct"),
        percent(test, total).alias("test_pct"),
        ratio(test, total, 4).alias("actual_test_ratio"),
    )


def split_leaks(df: DataFrame, donor: str) -> DataFrame:
    """Donors with cells on both sides; empty for a sound donor split."""
    sides = df.groupBy(donor).agg(F.min("split").alias("first"), F.max("split").alias("last"))
    return sides.filter(F.col("first") != F.col("last")).select(donor)


def split_validation(df: DataFrame, split: DataFrame, donor: str) -> DataFrame:
    """One row: donors before and after, donors on both sides, test shares by donor and by cell."""
    before = with_donor_key(df, donor).select(donor).distinct().agg(F.count("*").alias("n"))
    donors = split.groupBy(donor).agg(
        F.min("split").alias("first"), F.max("split").alias("last"),
        F.count("*").alias("cells"), F.count_if(F.col("split") == TEST).alias("test_cells"),
    )
    return donors.agg(
        F.count("*").alias("donors_split"),
        F.count_if(F.col("first") != F.col("last")).alias("donors_on_both_sides"),
        ratio(F.count_if(F.col("first") == TEST), F.count("*"), 4).alias("test_donor_ratio"),
        ratio(F.sum("test_cells"), F.sum("cells"), 4).alias("test_cell_ratio"),
    ).withColumn("donors_before", before.select("n").scalar())
