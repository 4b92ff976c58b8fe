import hashlib
import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cellspark.operators import joins, splits
from cellspark.operators.joins import hot_key_join, spread_join
from cellspark.operators.ranking import exact_median, rank_by_digest, with_row_index
from cellspark.session import materialize


def donors_table(spark, donors=10, cells=50, seed=3):
    rng = random.Random(seed)
    rows = []
    for d in range(donors):
        age = rng.uniform(20, 80)
        rows += [(f"donor_{d}", age + rng.gauss(0, 0.1), d * cells + c) for c in range(cells)]
    return spark.createDataFrame(rows, "donor_id string, age double, cell_id bigint")


def test_donor_split_has_no_leak_and_loses_nobody(spark):
    cells = donors_table(spark)
    split = splits.split_dataset(cells, ["cell_id"], test_size=0.2)
    rows = split.collect()
    sides = defaultdict(set)
    for r in rows:
        sides[r.donor_id].add(r.split)
    assert len(rows) == 500 and len(sides) == 10
    assert all(len(s) == 1 for s in sides.values())
    # Ten different ages: no strata, two test donors.
    assert sum(s == {"test"} for s in sides.values()) == 2
    assert splits.split_leaks(split, "donor_id").count() == 0
    check = splits.split_validation(cells, split, "donor_id").first()
    assert (check.donors_before, check.donors_split, check.donors_on_both_sides) == (10, 10, 0)
    assert 0.1 <= check.test_cell_ratio <= 0.3


def test_cell_split_without_donors(spark):
    cells = donors_table(spark).drop("donor_id")
    counts = Counter(r.split for r in splits.split_dataset(cells, ["cell_id"], test_size=0.2).collect())
    assert 0.15 <= counts["test"] / 500 <= 0.25


def expected_quota_split(donors, test_size, seed=42):
    """donor -> age; exact quotas by largest remainder, hash order, one stratum if strata are thin."""

    def digest(text):
        return hashlib.md5(f"{seed}:{text}".encode()).hexdigest()

    n, n_test = len(donors), math.ceil(test_size * len(donors))
    named = {d: str(round(a * 10) / 10) for d, a in donors.items()}
    counts = Counter(named.values())
    if min(counts.values()) < 2 or len(counts) > min(n_test, n - n_test):
        named = dict.fromkeys(donors, "all")
        counts = Counter(named.values())
    quota = {s: n_test * c // n for s, c in counts.items()}
    remainder = {s: n_test * c % n for s, c in counts.items()}
    left = n_test - sum(quota.values())
    for s in sorted(counts, key=lambda s: (-remainder[s], digest(s)))[:left]:
        quota[s] += 1
    test = set()
    for s in counts:
        members = sorted((d for d in donors if named[d] == s), key=digest)
        test |= set(members[: quota[s]])
    return test


@pytest.mark.parametrize("test_size", [0.05, 0.2, 0.37])
@pytest.mark.parametrize("shape", ["even", "uneven", "one_stratum", "lonely"])
def test_quota_split_matches_brute_force(spark, test_size, shape):
    rng = random.Random(5)
    ages = {
        "even": lambda i: 20.0 + 5 * (i % 7),
        "uneven": lambda i: 20.0 + (0 if i % 3 == 0 else rng.choice([5, 10, 10, 15.5])),
        "one_stratum": lambda i: 33.0,
        "lonely": lambda i: 20.0 if i else 99.0,
    }[shape]
    donors = {f"d{i}": ages(i) for i in range(203)}
    table = spark.createDataFrame([(d, 1, a) for d, a in donors.items()], "donor_id string, cells bigint, donor_age double")
    found = splits.quota_split(table, "donor_id", test_size)
    assert found.count() == 203
    test = {r.donor_id for r in found.collect() if r.split == "test"}
    assert test == expected_quota_split(donors, test_size)
    assert len(test) == math.ceil(test_size * 203)


def test_single_and_no_donor(spark):
    schema = "donor_id string, cells bigint, donor_age double"
    one = splits.quota_split(spark.createDataFrame([("a", 5, 30.0)], schema), "donor_id")
    assert [r.split for r in one.collect()] == ["train"]
    assert splits.quota_split(spark.createDataFrame([], schema), "donor_id").count() == 0


def test_missing_donors_stay_together(spark):
    cells = spark.createDataFrame(
        [(None if i < 40 else f"d{i % 6}", 30.0, i) for i in range(100)], "donor_id string, age double, cell_id bigint"
    )
    split = splits.split_donors_by_quota(cells, "donor_id", test_size=0.3)
    assert split.count() == 100
    assert {r.donor_id for r in split.collect()} == {"nan", *[f"d{i}" for i in range(6)]}
    assert splits.split_leaks(split, "donor_id").count() == 0


@pytest.mark.parametrize("keys_limit", [10**6, 0])
def test_hot_donor_join(spark, keys_limit, monkeypatch):
    """One donor holds a third of the rows; both ways of joining give the same rows."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", keys_limit)
    monkeypatch.setattr(joins, "HOT_SHARE", 10)
    facts = spark.range(3000).withColumn(
        "donor", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 500))
    )
    lookup = facts.groupBy("donor").agg(F.count("*").alias("cells")).withColumn("side", F.md5("donor"))
    joined = hot_key_join(facts, materialize(spark, lookup, "lookup"), "donor", "cells")
    rows = joined.collect()
    assert len(rows) == 3000 == len({r.id for r in rows})
    assert all(r.side == hashlib.md5(r.donor.encode()).hexdigest() for r in rows)


@pytest.mark.parametrize("limit", [100, 0])
def test_spread_join_keeps_all_rows(spark, limit, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_COPY", 50)
    facts = spark.range(1000).withColumn("k", F.when(F.col("id") < 700, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)))
    lookup = spark.createDataFrame([("hot", 1), ("k0", 2), ("k1", 3)], "k string, v int")
    rows = spread_join(facts, lookup, "k", ["id"], 3, limit).collect()
    assert Counter(r.v for r in rows) == {1: 700, 2: 60, 3: 60, None: 180}


def test_exact_median(spark):
    rng = random.Random(11)
    groups = {"hot": [rng.gauss(40, 20) for _ in range(2001)], "even": [1.0, 2.0, 2.04, 9.0], "one": [5.5], "ties": [3.0] * 6}
    groups["mixed"] = [None, 7.0, None, 8.0]
    groups["unknown"] = [None, None]
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r.k: (r.n, r.m) for r in exact_median(df, "k", "v", "m", "n").collect()}
    for k, vs in groups.items():
        known = [v for v in vs if v is not None]
        assert found[k] == (len(vs), statistics.median(known) if known else None)


def test_rank_by_digest(spark):
    df = spark.range(2000).withColumn("g", F.when(F.col("id") < 1500, "hot").otherwise("cold"))
    df = df.withColumn("digest", F.md5(F.col("id").cast("string")))
    rows = rank_by_digest(df, ["g"], "digest", "id").collect()
    for g in ("hot", "cold"):
        mine = sorted((r for r in rows if r.g == g), key=lambda r: r["digest"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))


def test_row_index(spark):
    keys = [7, 100, 3, 55, 4000, -2, 12]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    found = {r.k: r.row_idx for r in with_row_index(df, "k").collect()}
    assert found == {k: i for i, k in enumerate(sorted(keys))}
    many = with_row_index(spark.range(5000).withColumn("k", F.col("id") * F.col("id")), "k")
    assert all(r.id == r.row_idx for r in many.collect())
    assert with_row_index(df.limit(0), "k").count() == 0


def test_hash_split_needs_no_shuffle(spark):
    plan = splits.split_donors_by_hash(donors_table(spark), "donor_id")._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_statistics(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "train"), ("b", "test"), (None, "train")], "d string, split string")
    assert splits.donor_statistics(df, "d").first().asDict() == {
        "total_donors": 3,
        "total_cells": 4,
        "avg_cells_per_donor": 1.33,
    }
    assert splits.split_statistics(df).first().asDict() == {
        "total_cells": 4,
        "train_cells": 3,
        "test_cells": 1,
        "train_pct": 75.0,
        "test_pct": 25.0,
        "actual_test_ratio": 0.25,
    }
    empty = splits.split_statistics(df.limit(0)).first()
    assert (empty.total_cells, empty.test_pct, empty.actual_test_ratio) == (0, 0.0, 0.0)
