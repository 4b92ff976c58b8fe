"""Train/test splits and their statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellspark.functions.text import percent
from cellspark.operators.ages import (
    age_distribution,
    null_age_sample,
    null_age_stats,
    thin_ages,
    with_age,
    with_known_age,
)
from cellspark.operators.sets import lost_keys, shared_keys
from cellspark.operators.splits import (
    donor_ages,
    donor_statistics,
    quota_split,
    split_cells,
    split_cells_by_age,
    split_cells_by_row,
    split_donors_by_age,
    split_donors_by_hash,
    split_donors_by_quota,
    split_leaks,
    split_statistics,
    split_validation,
)
from cellspark.session import materialize
from workload.registry import query
from workload.tables import obs, sql, uniform_sql

_SIDE = "CASE WHEN {u} < {size} THEN 'test' ELSE 'train' END"


def aged(spark, folder):
    """Cells with the donor's age, unknown ages included."""
    return with_age(obs(spark, folder)).select("cell_id", "donor_id", "dataset_id", "development_stage", "age")


def sampled(spark, folder):
    """Cells with a known age that differs between the samples of a donor."""
    cells = with_age(obs(spark, folder), "sampling_stage").select("cell_id", "donor_id", "dataset_id", "age")
    return with_known_age(cells)


def _quota_sql(source: str, test_size: float) -> str:
    """Exact quotas by largest remainder over strata of rounded median age, with the fallback to one stratum."""
    return f"""
    , donor_ages AS (
      SELECT donor_id, count(*) AS cells, median(age) AS donor_age FROM {source} WHERE age IS NOT NULL GROUP BY 1
    ), named AS (
      SELECT *, (round_even(donor_age * 10, 0) / 10)::DOUBLE::VARCHAR AS wanted FROM donor_ages
    ), sizes AS (
      SELECT sum(n)::BIGINT AS n, count(*) AS strata, min(n) AS least, ceil({test_size}::DOUBLE * sum(n))::BIGINT AS n_test
      FROM (SELECT wanted, count(*) AS n FROM named GROUP BY 1)
    ), keyed AS (
      SELECT d.*, n, n_test, CASE WHEN least < 2 OR strata > n_test OR strata > n - n_test THEN 'all' ELSE wanted END
        AS stratum FROM named d, sizes
    ), strata AS (
      SELECT stratum, count(*) AS donors, (any_value(n_test) * count(*)) // any_value(n) AS base,
        (any_value(n_test) * count(*)) % any_value(n) AS remainder, any_value(n_test) AS n_test FROM keyed GROUP BY 1
    ), quotas AS (
      SELECT stratum, base + CASE WHEN remainder > 0 AND row_number() OVER (
        ORDER BY remainder DESC, md5('42:' || stratum), stratum) <= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS quota
      FROM strata
    ), donor_split AS (
      SELECT donor_id, cells, donor_age, k.stratum, CASE WHEN row_number() OVER (
        PARTITION BY k.stratum ORDER BY md5('42:' || donor_id), donor_id) <= quota THEN 'test' ELSE 'train' END AS split
      FROM keyed k JOIN quotas q ON k.stratum = q.stratum
    )"""


@query(
    "sp1_cell_random_split",
    sql(f"SELECT cell_id, {_SIDE.format(u=uniform_sql('cell_id'), size=0.05)} AS split FROM obs"),
)
def cell_random_split(spark, folder):
    return split_cells(obs(spark, folder).select("cell_id"), ["cell_id"])


@query(
    "sp2_cell_split_by_age",
    sql(f"""
    SELECT cell_id, age, {_SIDE.format(u=uniform_sql("round(age * 1000)::BIGINT || ':' || cell_id"), size=0.05)} AS split
    FROM aged WHERE age IS NOT NULL"""),
)
def cell_split_by_age(spark, folder):
    return split_cells_by_age(with_known_age(aged(spark, folder)), ["cell_id"]).select("cell_id", "age", "split")


@query(
    "sp3_donor_random_split",
    sql(f"SELECT cell_id, donor_id, {_SIDE.format(u=uniform_sql('donor_id'), size=0.05)} AS split FROM obs"),
)
def donor_random_split(spark, folder):
    return split_donors_by_hash(obs(spark, folder).select("cell_id", "donor_id"), "donor_id")


@query(
    "sp4_donor_split_by_age",
    sql(f"""
    , sides AS (SELECT donor_id, median(age) AS donor_age FROM sampled WHERE age IS NOT NULL GROUP BY 1)
    SELECT cell_id, s.donor_id, age,
      {_SIDE.format(u=uniform_sql("round(donor_age * 1000)::BIGINT || ':' || s.donor_id"), size=0.05)} AS split
    FROM sampled s JOIN sides d ON s.donor_id = d.donor_id WHERE age IS NOT NULL"""),
)
def donor_split_by_age(spark, folder):
    cells = sampled(spark, folder).select("cell_id", "donor_id", "age")
    return split_donors_by_age(cells, "donor_id")


@query(
    "sp5_donor_quota_split",
    sql(f"{_quota_sql('aged', 0.05)} SELECT donor_id, cells, donor_age, split FROM donor_split"),
)
def donor_quota_split(spark, folder):
    donors = materialize(spark, donor_ages(with_known_age(aged(spark, folder)), "donor_id"), "donors")
    return quota_split(donors, "donor_id").drop("stratum")


@query(
    "sp5_donor_quota_split_cells",
    sql(f"""{_quota_sql("sampled", 0.2)}
    SELECT cell_id, s.donor_id, age, split FROM sampled s JOIN donor_split d ON s.donor_id = d.donor_id
    WHERE age IS NOT NULL"""),
)
def donor_quota_split_cells(spark, folder):
    cells = sampled(spark, folder).select("cell_id", "donor_id", "age")
    return split_donors_by_quota(cells, "donor_id", test_size=0.2)


@query(
    "sp6_cell_hash_split",
    sql("""
    SELECT cell_id, age, CASE WHEN
      (('0x' || substr(md5('42:' || round(age * 1000)::BIGINT), 1, 8))::BIGINT
       + ('0x' || substr(md5('43:' || cell_id), 1, 8))::BIGINT) % 10000 / 10000.0::DOUBLE < 0.05
      THEN 'test' ELSE 'train' END AS split
    FROM aged WHERE age IS NOT NULL"""),
)
def cell_hash_split(spark, folder):
    cells = with_known_age(aged(spark, folder)).select("cell_id", "age")
    return split_cells_by_row(cells, "cell_id")


@query(
    "sp7_split_validation",
    sql(f"""
    , s AS (SELECT donor_id, {_SIDE.format(u=uniform_sql('donor_id'), size=0.05)} AS split FROM obs)
    , d AS (SELECT donor_id, min(split) AS lo, max(split) AS hi, count(*) AS cells,
              count(*) FILTER (split = 'test') AS test_cells FROM s GROUP BY 1)
    SELECT count(*) AS donors_split, (count(*) FILTER (lo <> hi))::BIGINT AS donors_on_both_sides,
      round((count(*) FILTER (lo = 'test'))::DOUBLE / count(*), 4) AS test_donor_ratio,
      round(sum(test_cells)::DOUBLE / sum(cells), 4) AS test_cell_ratio, count(DISTINCT donor_id) AS donors_before
    FROM d"""),
)
def validated_split(spark, folder):
    cells = obs(spark, folder).select("cell_id", "donor_id")
    return split_validation(cells, split_donors_by_hash(cells, "donor_id"), "donor_id")


@query(
    "sp7_cell_split_leaks",
    sql(f"""
    SELECT donor_id FROM (SELECT donor_id, {_SIDE.format(u=uniform_sql('cell_id'), size=0.05)} AS split FROM obs)
    GROUP BY 1 HAVING count(DISTINCT split) > 1"""),
)
def cell_split_leaks(spark, folder):
    """Donors that a split by cell puts on both sides."""
    return split_leaks(split_cells(obs(spark, folder).select("cell_id", "donor_id"), ["cell_id"]), "donor_id")


@query(
    "u5_shared_donors",
    sql(f"""
    , s AS (SELECT donor_id, {_SIDE.format(u=uniform_sql('cell_id'), size=0.05)} AS split FROM obs)
    SELECT donor_id FROM s WHERE split = 'train' INTERSECT SELECT donor_id FROM s WHERE split = 'test'"""),
)
def shared_donors(spark, folder):
    split = split_cells(obs(spark, folder).select("cell_id", "donor_id"), ["cell_id"])
    return shared_keys(split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test"), "donor_id")


@query(
    "u6_lost_donors",
    sql(f"""
    , s AS (SELECT donor_id, age, {_SIDE.format(u=uniform_sql('donor_id'), size=0.05)} AS split FROM aged)
    SELECT donor_id FROM s EXCEPT SELECT donor_id FROM s WHERE age IS NOT NULL"""),
)
def lost_donors(spark, folder):
    """Donors that the age filter takes out of both sides."""
    split = split_donors_by_hash(aged(spark, folder), "donor_id")
    kept = with_known_age(split)
    sides = [kept.filter(F.col("split") == side) for side in ("train", "test")]
    return lost_keys(split, "donor_id", *sides)


@query(
    "a7_donor_median_age",
    sql("SELECT donor_id, count(*) AS cells, median(age) AS donor_age FROM sampled GROUP BY 1"),
)
def donor_median_age(spark, folder):
    """Donors without a known age are kept, with a null median."""
    cells = with_age(obs(spark, folder), "sampling_stage").select("donor_id", "age")
    return donor_ages(cells, "donor_id")


@query(
    "a14_null_age_stats",
    sql("""
    SELECT count(*) AS cells_before_filtering, count(age) AS cells_after_filtering,
      (count(*) - count(age))::BIGINT AS cells_discarded,
      round((count(*) - count(age))::DOUBLE * 100 / count(*), 2) AS discard_percentage FROM aged"""),
)
def null_ages(spark, folder):
    return null_age_stats(aged(spark, folder))


@query(
    "a14_null_age_sample",
    sql("SELECT cell_id, development_stage, age FROM aged WHERE age IS NULL ORDER BY cell_id LIMIT 10"),
)
def null_age_samples(spark, folder):
    return null_age_sample(aged(spark, folder), "cell_id")


@query(
    "a15_filtering_summary",
    sql("""
    SELECT dataset_id, count(*) AS cells_before, count(age) AS cells_after, count(*) - count(age) AS discarded,
      round((count(*) - count(age))::DOUBLE * 100 / count(*), 2) AS discard_percentage FROM aged GROUP BY 1"""),
)
def filtering_summary(spark, folder):
    lost = F.count_if(F.col("age").isNull())
    return aged(spark, folder).groupBy("dataset_id").agg(
        F.count("*").alias("cells_before"),
        F.count("age").alias("cells_after"),
        lost.alias("discarded"),
        percent(lost, F.count("*")).alias("discard_percentage"),
    )


@query(
    "a16_thin_ages",
    sql("SELECT age, count(*) AS cells FROM sampled WHERE age IS NOT NULL GROUP BY 1 HAVING count(*) < 100"),
)
def thin_age_groups(spark, folder):
    return thin_ages(sampled(spark, folder), 0.01)


@query(
    "a17_donor_statistics",
    sql("""
    SELECT count(DISTINCT donor_id) AS total_donors, count(*) AS total_cells,
      round(count(*)::DOUBLE / count(DISTINCT donor_id), 2) AS avg_cells_per_donor FROM obs"""),
)
def donor_stats(spark, folder):
    return donor_statistics(obs(spark, folder), "donor_id")


@query(
    "a18_split_statistics",
    sql(f"""
    , s AS (SELECT {_SIDE.format(u=uniform_sql('donor_id'), size=0.05)} AS split FROM obs)
    SELECT count(*) AS total_cells, (count(*) FILTER (split = 'train'))::BIGINT AS train_cells,
      (count(*) FILTER (split = 'test'))::BIGINT AS test_cells,
      round((count(*) FILTER (split = 'train'))::DOUBLE * 100 / count(*), 2) AS train_pct,
      round((count(*) FILTER (split = 'test'))::DOUBLE * 100 / count(*), 2) AS test_pct,
      round((count(*) FILTER (split = 'test'))::DOUBLE / count(*), 4) AS actual_test_ratio FROM s"""),
)
def split_stats(spark, folder):
    return split_statistics(split_donors_by_hash(obs(spark, folder).select("donor_id"), "donor_id"))


@query(
    "a19_age_distribution_by_side",
    sql(f"""
    SELECT {_SIDE.format(u=uniform_sql('donor_id'), size=0.05)} AS split, age, count(*) AS cells
    FROM sampled WHERE age IS NOT NULL GROUP BY 1, 2"""),
)
def age_distribution_by_side(spark, folder):
    split = split_donors_by_hash(sampled(spark, folder).select("donor_id", "age"), "donor_id")
    return age_distribution(split, by=("split",))
