import re

import pytest
from pyspark.sql import functions as F

from cellspark.operators import genes as gene_operators
from cellspark.operators.sentences import sentences_from_arrays
from cellspark.plans import build
from cellspark.session import scratch_path
from cellspark.sinks.parquet import write_by_cell

CELL = ["dataset_id", "cell_id"]


@pytest.fixture
def tables(spark):
    """Two datasets of 40 cells; the second half of the cells, and all of a third dataset, have no age."""
    stage = F.when((F.col("id") < 20) & (F.col("d") != "c"), F.concat((F.col("id") + 20).cast("string"), F.lit("-year-old human stage"))).otherwise("unknown")
    cells = spark.range(40).withColumn("d", F.explode(F.array(*map(F.lit, "abc"))))
    obs = cells.select(F.col("d").alias("dataset_id"), F.col("id").alias("cell_id"), F.concat(F.lit("p"), F.col("id") % 7).alias("donor_id"), stage.alias("development_stage"))
    genes = spark.range(5).withColumn("dataset_id", F.explode(F.array(*map(F.lit, "abc"))))
    var = genes.select("dataset_id", F.col("id").alias("gene_idx"), F.concat(F.lit("ENSG"), "id").alias("ensembl_gene_id"), F.concat(F.lit("g"), "id").alias("feature_name"))
    expr = obs.select(*CELL).join(var.select("dataset_id", "gene_idx"), "dataset_id").withColumn("value", ((F.col("cell_id") * 3 + F.col("gene_idx") * 7) % 11 + 1).cast("double"))
    return obs, var, expr


OPTIONS = build.BuildOptions(top_n=3, include_zeros=False, use_hgnc=False, stratify_by_age=False)


def sentence(cell):
    values = [((cell * 3 + g * 7) % 11 + 1, g) for g in range(5)]
    return " ".join(f"g{g}" for _, g in sorted(values, reverse=True))


def test_dropped_cells_do_not_move(spark, tables):
    obs, var, expr = tables
    path = scratch_path(spark, "expr")
    expr.write.parquet(path)
    built = build.build_dataset(obs, var, spark.read.parquet(path), options=OPTIONS)
    rows = {(r.dataset_id, r.cell_id): r.gene_sentence_all for r in built.collect()}
    assert rows == {(d, c): sentence(c) for d in "ab" for c in range(20)}
    plan = built._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "gene_idx" in line)
    above = [line for line in plan[:scan] if re.search("Exchange hashpartitioning|LeftSemi", line)]
    assert "LeftSemi" in above[-1]  # the nearest to the scan


@pytest.mark.parametrize("limit", [0, 2, 200_000])
@pytest.mark.parametrize("form", ["long", "array"])
def test_kept_cells_beyond_the_limit(spark, tables, monkeypatch, limit, form):
    from cellspark.operators.sentences import to_sparse

    monkeypatch.setattr(build, "BROADCAST_ROWS", limit)
    obs, var, expr = tables
    built = build.build_dataset(obs, var, expr if form == "long" else to_sparse(expr, CELL), options=OPTIONS)
    assert {(r.dataset_id, r.cell_id): r.gene_sentence_all for r in built.collect()} == {(d, c): sentence(c) for d in "ab" for c in range(20)}


def test_bucketed_expression_stays_where_it_is(spark, tables):
    obs, var, expr = tables
    stored = write_by_cell(expr, "bucketed_expression", scratch_path(spark, "buckets"), 8)
    try:
        built = build.build_dataset(obs, var, stored, options=OPTIONS)
        assert {(r.dataset_id, r.cell_id): r.gene_sentence_all for r in built.collect()} == {(d, c): sentence(c) for d in "ab" for c in range(20)}
        plan = built._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
        scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "gene_idx" in line)
        depth = len(plan[scan]) - len(plan[scan].lstrip(" :|+-*"))
        for line in reversed(plan[:scan]):
            indent = len(line) - len(line.lstrip(" :|+-*"))
            if indent < depth:
                depth = indent
                assert "Exchange" not in line or "Broadcast" in line, line
    finally:
        spark.sql("DROP TABLE bucketed_expression")


def test_many_lists_share_few_numbers(spark):
    names = [f"list {i}" for i in range(17)]
    rows = [("d", g, f"G{g}" if g % 5 else f"ENSG{g}", *[g % (i + 2) == 0 for i in range(17)]) for g in range(40) if g != 13]
    genes = spark.createDataFrame(rows, ["dataset_id", "gene_idx", "symbol", *[f"in_{n}" for n in names]])
    panel = gene_operators.gene_panel(genes, names)
    assert [c for c in panel.columns if c.startswith("flags_")] == ["flags_0", "flags_1"]
    cells = spark.createDataFrame([("d", 1, [3, 7, 30, 13, 12, 10, 60], [5.0, 9.0, 2.0, 8.0, 2.0, 1.0, 3.0])], "dataset_id string, cell_id long, indices array<int>, values array<double>")
    for zeros in (True, False):
        row = sentences_from_arrays(cells, genes, CELL, 2, names, include_zeros=zeros).first()
        order = [7, 3, 30, 12, 10] + [g for g in range(39, -1, -1) if g not in (7, 3, 30, 12, 10)] * zeros
        order = [g for g in order if g % 5 and g != 13]
        assert row["gene_sentence_all"] == " ".join(f"G{g}" for g in order)
        for i, name in enumerate(names):
            assert row[f"gene_sentence_{name}"] == " ".join(f"G{g}" for g in order if g % (i + 2) == 0)


@pytest.mark.parametrize("numbers", [[0, 1, 1], [-1, 0], [None, 0]])
def test_wrong_gene_numbers(spark, numbers):
    genes = spark.createDataFrame([("d", n, "x") for n in numbers], "dataset_id string, gene_idx int, symbol string")
    cells = spark.createDataFrame([("d", 1, [0], [1.0])], "dataset_id string, cell_id long, indices array<int>, values array<double>")
    with pytest.raises(ValueError, match="gene_idx"):
        sentences_from_arrays(cells, genes, CELL, 2)


PUBLICATIONS = "dataset_id string, collection_id string, title string, doi string, description string, contact_name string, contact_email string"


@pytest.fixture
def publications(spark):
    """Of dataset a in two collections, of none of the others; one record has gaps, one no dataset."""
    rows = [("a", "c1", "T1", "d", "x", "n", "e"), ("a", "c2", None, None, None, None, None), (None, "c3", "T3", "d", "x", "n", "e")]
    return spark.createDataFrame(rows, PUBLICATIONS)


def test_publications_are_joined_to_finished_sentences(spark, tables, publications):
    """A cell of two collections gets its sentence made once, and no publication column is stored or shuffled."""
    obs, var, expr = tables
    built = build.build_dataset(obs, var, expr, collections=publications, options=OPTIONS)
    rows = sorted((r.dataset_id, r.collection_id, r.publication_title, r.cell_id, r.gene_sentence_all) for r in built.collect())
    records = [("a", "c1", "T1"), ("a", "c2", "nan"), ("b", "nan", "nan")]
    assert rows == [(*record, c, sentence(c)) for record in records for c in range(20)]
    plan = built._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
    assert not [line for line in plan if re.search("Exchange hashpartitioning|FileScan", line) and "collection_id" in line]


@pytest.mark.parametrize(
    "changes", [{}, {"age_mode": "species"}, {"skip_split": True}, {"stratify_by_age": True}, {"filter_by_age": False, "include_zeros": True}]
)
@pytest.mark.parametrize("twice", [True, False])
def test_publications_first_or_last_give_the_same(tables, publications, monkeypatch, changes, twice):
    obs, var, expr = tables
    obs = obs.withColumns({"organism": F.lit("Homo sapiens"), "age": F.lit("old")})
    collections = publications if twice else publications.where("collection_id <> 'c2'")
    options = build.replace(OPTIONS, **changes)
    last = build.publications_come_last(obs, collections, options)
    assert last == (not twice or "stratify_by_age" not in changes)  # quotas count a cell as often as it stands there
    found = build.build_dataset(obs, var, expr, collections=collections, options=options)
    monkeypatch.setattr(build, "PUBLICATION_BYTES", -1)
    first = build.build_dataset(obs, var, expr, collections=collections, options=options)
    assert found.columns == first.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, first.collect()))
