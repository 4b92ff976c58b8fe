import os
import re

import pytest
from pyspark.sql import functions as F

from cellspark.session import scratch_path
from cellspark.sinks.parquet import rechunk, write_chunks, write_exact_rows, write_exact_split
from cellspark.sources import positions


@pytest.fixture
def folder(spark, tmp_path):
    """Rows 0 to 99 in files of unlike size whose names have odd characters."""
    path = tmp_path / "in [1] %20 +"
    for i, (first, end) in enumerate([(0, 40), (40, 41), (41, 90), (90, 100)]):
        spark.range(first, end).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        source = next(p for p in os.listdir(tmp_path / f"part{i}") if p.endswith(".parquet"))
        path.mkdir(exist_ok=True)
        (path / f"chunk_{i:04d} a%b+c.parquet").write_bytes((tmp_path / f"part{i}" / source).read_bytes())
    return str(path).replace("[", "\\[").replace("]", "\\]")


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def exchanges(df):
    return [line for line in re.findall(r"\w*Exchange\b", plan_of(df)) if line != "BroadcastExchange"]


def test_positions(spark, folder):
    numbered = positions.with_positions(spark, folder)
    assert sorted(map(tuple, numbered.collect())) == [(i, i) for i in range(100)]
    assert exchanges(numbered) == []
    assert positions.with_positions(spark, folder, "n", ["id", "not_there"]).columns == ["id", "n"]


@pytest.mark.parametrize(("start", "end"), [(0, 100), (0, None), (39, 42), (40, 41), (55, 60), (0, 1), (99, 100), (7, 7), (100, 120), (95, 300)])
def test_row_ranges(spark, folder, start, end):
    found = positions.scan_rows(spark, folder, start, end, name="row")
    expected = list(range(start, min(100, 100 if end is None else end)))
    assert sorted(map(tuple, found.collect())) == [(i, i) for i in expected]
    assert sorted(r.id for r in positions.scan_rows(spark, folder, start, end, ["id"]).collect()) == expected
    assert exchanges(found) == []


def test_only_needed_files_are_read(spark, folder):
    rows = positions.scan_rows(spark, folder, 41, 90)
    assert [os.path.basename(f)[:10] for f in rows.inputFiles()] == ["chunk_0002"]


def test_pages_and_covering_ranges(spark, folder):
    assert [r.id for r in positions.page(spark, folder, 38, 5).collect()] == [38, 39, 40, 41, 42]
    assert positions.row_ranges(spark, folder, 30) == [(0, 30), (30, 60), (60, 90), (90, 100)]
    for wrong in (lambda: positions.scan_rows(spark, folder, -1), lambda: positions.scan_rows(spark, folder, 5, 2), lambda: positions.row_ranges(spark, folder, 0)):
        with pytest.raises(ValueError):
            wrong()


def test_without_broadcast(spark, folder, monkeypatch):
    monkeypatch.setattr(positions, "BROADCAST_FILES", 1)
    assert sorted(map(tuple, positions.with_positions(spark, folder).collect())) == [(i, i) for i in range(100)]


def sizes(spark, path):
    found = {}
    for file in sorted(os.listdir(path)):
        if file.endswith(".parquet"):
            ids = [r.id for r in spark.read.parquet(f"{path}/{file}").collect()]
            found[file] = ids
    return found


@pytest.mark.parametrize(("partitions", "rows"), [(1, 7), (3, 1000), (41, 50), (41, 203)])
def test_exact_rows(spark, partitions, rows):
    path = scratch_path(spark, "exact")
    write_exact_rows(spark.range(0, 203, 1, partitions), path, rows, "cells")
    found = sizes(spark, path)
    expected = {f"cells_{s:07d}_{min(s + rows, 203):07d}.parquet": list(range(s, min(s + rows, 203))) for s in range(0, 203, rows)}
    assert found == expected


def test_exact_rows_of_skewed_and_empty_partitions(spark):
    path = scratch_path(spark, "exact")
    skewed = spark.range(0, 500, 1, 1).unionByName(spark.range(500, 520, 1, 30)).where("id < 430 OR id >= 500")
    write_chunks(skewed, path, chunk_size=64, exact=True)
    assert sorted(map(len, sizes(spark, path).values())) == [450 % 64, *[64] * 7]
    assert sorted(i for ids in sizes(spark, path).values() for i in ids) == [*range(430), *range(500, 520)]
    empty = scratch_path(spark, "exact")
    write_exact_rows(spark.range(0), empty, 5, "none")
    assert spark.read.parquet(empty).count() == 0 and spark.read.parquet(empty).columns == ["id"]
    with pytest.raises(ValueError):
        write_exact_rows(spark.range(3), scratch_path(spark, "exact"), 0)


def test_many_tasks_with_several_files_each(spark, monkeypatch):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    spark.range(0, 5000, 1, 6).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rechunk(spark, path, out, 90, "x")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sizes(spark, out) == {f"x_{s:07d}_{min(s + 90, 5000):07d}.parquet": list(range(s, min(s + 90, 5000))) for s in range(0, 5000, 90)}


def test_exact_split(spark):
    path = scratch_path(spark, "exact-split")
    rows = spark.range(0, 300, 1, 7).withColumn("split", F.when(F.col("id") % 10 == 0, "test").otherwise("train"))
    write_exact_split(rows, path, "ds", 100)
    assert {f: len(ids) for f, ids in sizes(spark, f"{path}/ds/split=train").items()} == {
        "ds_0000000_0000100.parquet": 100,
        "ds_0000100_0000200.parquet": 100,
        "ds_0000200_0000270.parquet": 70,
    }
    assert spark.read.parquet(f"{path}/ds").groupBy("split").count().orderBy("split").collect() == [("test", 30), ("train", 270)]


def test_many_small_files_of_one_stored_file_are_written_by_several_tasks(spark):
    """Before, one task wrote all 200 files, as the input was one partition."""
    path, plain, named = (scratch_path(spark, n) for n in ("in", "plain", "named"))
    spark.range(0, 1996, 1, 1).write.parquet(path)
    rechunk(spark, path, plain, 10)
    assert len({f.split("-")[1] for f in os.listdir(plain) if f.startswith("part-")}) == 4
    rechunk(spark, path, named, 10, "x")
    files = sorted(f for f in os.listdir(named) if f.endswith(".parquet"))
    assert files == [f"x_{s:07d}_{min(s + 10, 1996):07d}.parquet" for s in range(0, 1996, 10)]
    found = spark.read.parquet(named).select("id", F.regexp_extract(F.col("_metadata.file_path"), r"x_(\d+)_", 1).cast("long").alias("first"))
    assert found.where("id < first OR id >= first + 10").count() == 0 and found.distinct().count() == 1996
