import os
from collections import defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F

from cellspark.functions.text import path_stem
from cellspark.plans import isolation
from cellspark.plans.batch import batch_report
from cellspark.session import materialize
from cellspark.streaming.ingest import read_ingested
from cellspark.streaming.ingest import ingest_new_files
from cellspark.streaming.quotas import ARRIVAL, ingest_with_quotas, read_donor_sides

SCHEMA = "cell_id bigint, name string"


@pytest.fixture
def inputs(spark, tmp_path):
    """Ten datasets in one folder: one truncated, one with a hole in its pages, one without a byte, one that is text."""
    folder = tmp_path / "in put"
    folder.mkdir()
    for i in range(10):
        rows = spark.range(i * 1000, i * 1000 + 300).selectExpr("id AS cell_id", "md5(string(id)) AS name")
        rows.coalesce(1).write.parquet(str(tmp_path / f"made{i}"))
        source = next(p for p in os.listdir(tmp_path / f"made{i}") if p.endswith(".parquet"))
        data = (tmp_path / f"made{i}" / source).read_bytes()
        if i == 2:
            data = data[: len(data) // 2]
        if i == 4:
            data = data[:1500] + bytes(len(data) - 3000) + data[-1500:]
        if i == 6:
            data = b""
        if i == 8:
            data = b"this is text\n" * 50
        (folder / f"ds {i}+x%20.parquet").write_bytes(data)
    return str(folder)


def test_broken_files_do_not_end_a_batch(spark, inputs):
    schema = spark.createDataFrame([], SCHEMA).schema
    checked = materialize(spark, isolation.check_files(spark, inputs, schema, dataset=lambda p: path_stem(p)), "checked")
    sound = {r["dataset_name"]: r["sound"] for r in checked.collect()}
    assert sound == {f"ds {i}+x%20": i not in (2, 4, 6, 8) for i in range(10)}
    rows = isolation.sound_rows(spark, inputs, schema, checked, dataset=lambda p: path_stem(p))
    expected = sorted(c for i in (0, 1, 3, 5, 7, 9) for c in range(i * 1000, i * 1000 + 300))
    assert sorted(r["cell_id"] for r in rows.collect()) == expected
    planned = checked.select("dataset_name", F.lit("run").alias("action"), F.lit(None).cast("string").alias("message"))
    report = {r["dataset_name"]: r for r in batch_report(planned, rows, broken=isolation.broken_datasets(checked)).collect()}
    assert {n for n, r in report.items() if r["status"] == "FAILED"} == {f"ds {i}+x%20" for i in (2, 4, 6, 8)}
    assert report["ds 2+x%20"]["message"].startswith("unreadable: ") and report["ds 0+x%20"]["cells"] == 300


def test_one_broken_file_fails_its_whole_dataset(spark, tmp_path):
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).write.parquet(str(tmp_path / f"in/dataset_id=d{i}"))
    (tmp_path / "in/dataset_id=d1/late.parquet").write_bytes(b"PAR1 broken PAR1")
    schema = spark.range(0).schema
    checked = materialize(spark, isolation.check_files(spark, str(tmp_path / "in"), schema, dataset=isolation.dataset_of_partition), "checked")
    rows = isolation.sound_rows(spark, str(tmp_path / "in"), schema, checked, dataset=isolation.dataset_of_partition)
    assert sorted(map(tuple, rows.select("dataset_id", "id").collect())) == sorted((f"d{i}", i * 10 + j) for i in (0, 2) for j in range(10))


FIELDS = "cell_id bigint, donor_id string, age double"


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("append").parquet(folder)


def deliveries():
    """Donors come back in later files, with other ages; one donor has a third of all cells; some have none or no age."""
    files = []
    for i in range(5):
        rows = [(1000 * i + j, f"p{(j * (i + 1)) % (30 + 20 * i)}", [20.0, 40.5, 61.25][j % (30 + 20 * i) % 3] + (i if j % 9 == 0 else 0)) for j in range(80)]
        rows += [(1000 * i + 500 + j, "hot", 33.0) for j in range(40)] + [(1000 * i + 900, None, 50.0), (1000 * i + 901, f"n{i}", None)]
        files.append(rows)
    return files


def sides(spark, target):
    return {r["cell_id"]: (r["donor_id"], r["split"]) for r in read_ingested(spark, target).collect()}


def test_quota_ingest(spark, tmp_path):
    schema = spark.createDataFrame([], FIELDS).schema
    source = str(tmp_path / "in")

    def run(name, files, **options):
        ingest_with_quotas(spark, source, schema, f"{tmp_path}/{name}", f"{tmp_path}/{name}-progress", lambda df: df, test_size=0.25, files_per_batch=files, **options)
        return sides(spark, f"{tmp_path}/{name}")

    grown, files = {}, deliveries()
    for rows in files:
        deliver(spark, source, rows)
        before, grown = grown, run("grown", 1)
        assert {k: grown[k] for k in before} == before
    assert len(grown) == sum(map(len, files))
    by_donor = {}
    for donor, side in grown.values():
        assert by_donor.setdefault(donor, side) == side
    # At once, and three files at a time: the same sides.
    assert run("whole", 1000) == grown
    assert run("thirds", 3) == grown

    # Every stratum of ages at first sight has its share, to within one, after every file.
    strata, seen = {}, {}
    for i, rows in enumerate(files):
        ages = defaultdict(list)
        for _, donor, age in rows:
            ages[donor or "nan"].append(age)
        for donor, values in ages.items():
            known = [a for a in values if a is not None]
            if donor not in seen:
                seen[donor] = i
                strata[donor] = round(median(known) * 10) / 10 if known else None
        for stratum in set(strata.values()):
            members = [d for d, s in strata.items() if s == stratum]
            assert abs(sum(by_donor[d] == "test" for d in members) - 0.25 * len(members)) < 1
    state = {r["donor"]: r["split"] for r in read_donor_sides(spark, f"{tmp_path}/grown").collect()}
    assert state == by_donor

    # The last batch again, as after a failure before its progress was noted.
    commits = tmp_path / "grown-progress" / "commits"
    for name in ("4", ".4.crc"):
        if (commits / name).exists():
            (commits / name).unlink()
    assert run("grown", 1) == grown
    assert read_donor_sides(spark, f"{tmp_path}/grown").count() == len(by_donor)
    assert ARRIVAL not in read_ingested(spark, f"{tmp_path}/grown").columns


@pytest.mark.parametrize("ingest", [ingest_new_files, ingest_with_quotas])
def test_a_batch_is_not_taken_for_a_tiny_table(spark, tmp_path, ingest):
    """Before, a join in the transform broadcast the whole batch, through the driver."""
    cells = spark.range(20_000).selectExpr("id AS cell_id", "concat('d', id % 50) AS donor_id", "cast(id % 7 AS double) AS age", "sha2(string(id), 256) AS x")
    cells.coalesce(1).write.parquet(f"{tmp_path}/in")
    plans = []

    def transform(batch):
        more = spark.read.parquet(f"{tmp_path}/in").select("cell_id", F.col("x").alias("y"))
        joined = batch.join(more, "cell_id")
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined.drop("x", "y")

    schema = "cell_id bigint, donor_id string, age double, x string"
    ingest(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, f"{tmp_path}/out", f"{tmp_path}/progress", transform)
    assert plans and not any("Broadcast" in p for p in plans)
    assert spark.read.parquet(f"{tmp_path}/out/cells").count() == 20_000
