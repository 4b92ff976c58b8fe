"""Rows dealt over tasks by their number."""

import pytest
from pyspark.sql import functions as F

from cellspark.operators import joins
from cellspark.operators.sentences import to_sparse
from workload.tables import expr, panel_expr

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 500)


def tasks(rows):
    """Rows of every task that has some."""
    return rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).filter(bool).collect()


def test_no_task_groups_many_rows(spark, few_rows):
    found = tasks(expr(spark, FOLDER))
    assert len(found) > 8 and max(found) < 1000
    assert sum(found) == spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_orderkey", "l_partkey").distinct().count()


def test_expression_by_dataset_moves_once(spark, few_rows):
    cells = to_sparse(panel_expr(spark, FOLDER, "l_suppkey"), ["dataset_id", "cell_id"])
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert sum(tasks(cells)) == cells.count()


@pytest.fixture
def folder(spark, tmp_path):
    """A folder of line items, by the number of rows of every dataset of a thousand parts."""

    def of(rows_by_dataset):
        items = [(i, d * 1000 + i % 7, i % 5, 1.0) for d, n in enumerate(rows_by_dataset) for i in range(n)]
        items = spark.createDataFrame(items, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double")
        items.write.parquet(str(tmp_path / f"{len(rows_by_dataset)}" / "lineitem.parquet"))
        return str(tmp_path / f"{len(rows_by_dataset)}")

    return of


def tasks_by_dataset(spark, folder):
    cells = to_sparse(panel_expr(spark, folder, "l_suppkey"), ["dataset_id", "cell_id"])
    placed = cells.withColumn("task", F.spark_partition_id()).groupBy("dataset_id").agg(F.count_distinct("task").alias("n"), F.sum(F.size("indices")).alias("genes"))
    return {r["dataset_id"]: (r["n"], r["genes"]) for r in placed.collect()}


def test_cells_of_a_dataset_stand_together(spark, few_rows, folder):
    found = tasks_by_dataset(spark, folder([35] * 40))
    assert found == {f"block_{d}": (1, 35) for d in range(40)}


def test_a_large_dataset_goes_to_many_tasks(spark, few_rows, folder):
    found = tasks_by_dataset(spark, folder([35] * 60 + [1000]))
    assert found["block_60"][0] > 1 and all(genes == 35 for _, genes in found.values())
    assert tasks_by_dataset(spark, folder([500, 500]))["block_0"][0] > 1  # two datasets would leave tasks idle


def test_no_rows_are_dealt(spark, folder):
    assert tasks_by_dataset(spark, folder([0])) == {}
