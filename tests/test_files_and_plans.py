import json
import os

import pytest
from pyspark.sql import functions as F

from cellspark.operators.inventory import filter_by_size, filter_unfinished, finished_datasets, older_than, run_totals
from cellspark.operators.inventory import storage_by
from cellspark.operators.splits import split_leaks
from cellspark.plans.batch import batch_report, plan_batch, run_batch
from cellspark.plans.build import BuildOptions, build_dataset, convert_dataset
from cellspark.plans.metadata import extract_metadata, resplit_dataset, store_metadata, store_species_summary
from cellspark.session import scratch_path
from cellspark.sinks.parquet import (
    write_all_splits,
    write_by_rows,
    write_by_size,
    write_chunks,
    write_parquet,
    write_split,
)
from cellspark.sinks.summaries import write_by_organism, write_summary
from cellspark.sources.files import entry_of, list_files, read_collections, read_event_log
from cellspark.sources.tables import (
    gene_list_names,
    read_chunks,
    read_datasets,
    read_gene_lists,
    read_symbol_table,
    read_typed_symbol_table,
    scan_metadata,
)
from cellspark.streaming.ingest import ingest_new_files, read_ingested


def test_gene_lists(spark, tmp_path):
    (tmp_path / "big.list.txt").write_text(" A \n\nB\nA\n\tC\n")
    (tmp_path / "small.txt").write_text("a")
    (tmp_path / "notes.md").write_text("X")
    lists = read_gene_lists(spark, str(tmp_path))
    assert sorted(map(tuple, lists.collect())) == [("big.list", g) for g in "ABC"] + [("small", "a")]
    assert gene_list_names(lists) == ["big.list", "small"]
    assert read_gene_lists(spark, str(tmp_path / "missing")).count() == 0
    os.mkdir(tmp_path / "empty")
    assert read_gene_lists(spark, str(tmp_path / "empty")).count() == 0


def test_symbol_table(spark, tmp_path):
    path = tmp_path / "symbols.tsv"
    path.write_text('ensembl_gene_id\tsymbol\tomim_id\trank\nENSG1\tA\t312095|465000\t1\nENSG2\tB "x\t12\t2\n')
    typed = read_typed_symbol_table(spark, str(path))
    types = {"ensembl_gene_id": "string", "symbol": "string", "omim_id": "string", "rank": "int", "table_row": "bigint"}
    assert dict(typed.dtypes) == types
    assert [r.symbol for r in typed.orderBy("table_row").collect()] == ["A", 'B "x']
    assert [r.omim_id for r in typed.orderBy("rank").collect()] == ["312095|465000", "12"]
    assert set(dict(read_symbol_table(spark, str(path)).drop("table_row").dtypes).values()) == {"string"}


def test_event_log_and_collections(spark, tmp_path):
    events = [{"message_type": "a", "total_cells": 3, "timestamp": 1.5}, {"action_type": "b", "task_level": [1]}]
    (tmp_path / "log.json").write_text("\n".join(map(json.dumps, events)))
    found = read_event_log(spark, str(tmp_path / "log.json")).collect()
    assert [(r.message_type, r.total_cells, r.task_level) for r in found] == [("a", 3, None), (None, None, [1])]
    record = {"collection_id": "c", "name": "N", "datasets": [{"id": "d"}, {"dataset_id": "e"}, {}]}
    (tmp_path / "collections.json").write_text(json.dumps([record], indent=1))
    rows = read_collections(spark, str(tmp_path / "collections.json")).collect()
    assert sorted((r.dataset_id, r.title, r.doi, r.description) for r in rows) == [("d", "N", None, ""), ("e", "N", None, "")]


def test_chunk_scan_and_row_range(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "a"))
    source = next(p for p in os.listdir(tmp_path / "a") if p.endswith(".parquet"))
    for name in ("chunk_0000.parquet", "other.parquet"):
        (tmp_path / name).write_bytes((tmp_path / "a" / source).read_bytes())
    assert read_chunks(spark, str(tmp_path), "chunk_*.parquet").count() == 5
    own = scratch_path(spark, "chunks")
    write_chunks(spark.range(50), own, chunk_size=7)
    assert read_chunks(spark, own).count() == 50
    df = read_chunks(spark, str(tmp_path), "chunk_*.parquet").withColumn("v", F.lit("x"))
    assert [r.id for r in scan_metadata(df, ["id"], "id", 1, 3).orderBy("id").collect()] == [1, 2]


def test_files_by_rows_and_size(spark):
    path = scratch_path(spark, "rows")
    write_by_rows(spark.range(0, 1000, 1, 2), path, 100)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count().collect()
    assert len(per_file) == 10 and all(r["count"] == 100 for r in per_file)
    big = spark.range(0, 60000, 1, 1).select(F.md5(F.col("id").cast("string")).alias("m"))
    path = scratch_path(spark, "size")
    write_chunks(big, path, chunk_size=10, target_mb=0.25)
    sizes = [r.length for r in list_files(spark, path, "*.parquet").collect()]
    assert spark.read.parquet(path).count() == 60000
    assert len(sizes) > 3 and max(sizes) < 1.3 * 0.25 * 1024 * 1024
    path = scratch_path(spark, "many-small")
    write_by_size(big.repartition(64), path, 0.25)
    shares = [r.length / (0.25 * 1024 * 1024) for r in list_files(spark, path, "*.parquet").collect()]
    assert 0.5 < min(shares) and max(shares) < 1.3
    sizes = []
    for level in (1, 9):
        path = scratch_path(spark, f"gzip-{level}")
        write_parquet(big, path, "gzip", level)
        sizes.append(sum(r.length for r in list_files(spark, path, "*.parquet").collect()))
    assert sizes[1] < sizes[0]
    with pytest.raises(ValueError):
        write_parquet(big, scratch_path(spark, "snappy"), "snappy", 9)
    path = scratch_path(spark, "empty")
    write_by_size(big.limit(0), path, 1)
    assert spark.read.schema("m string").parquet(path).count() == 0


def test_split_folders(spark):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 90, "train").otherwise("test"))
    path = scratch_path(spark, "split")
    write_split(df, path, "my_set")
    back = read_datasets(spark, [f"{path}/my_set"])
    assert {tuple(r) for r in back.groupBy("dataset_id", "split").count().collect()} == {
        ("my_set", "train", 90),
        ("my_set", "test", 10),
    }
    files = list_files(spark, path, "*.parquet")
    assert [r.dataset_name for r in finished_datasets(files).collect()] == ["my_set"]
    whole = scratch_path(spark, "all")
    write_all_splits(df.withColumn("dataset_id", F.lit("d")), whole)
    assert spark.read.parquet(f"{whole}/dataset_id=d/split=test").count() == 10
    assert [r.dataset_name for r in finished_datasets(list_files(spark, whole, "*.parquet")).collect()] == ["d"]
    again = read_datasets(spark, [whole]).groupBy("dataset_id", "split").count().collect()
    assert {tuple(r) for r in again} == {("d", "train", 90), ("d", "test", 10)}
    plain = scratch_path(spark, "plain")
    df.filter("split = 'test'").drop("split").write.parquet(f"{plain}/old/test")
    assert {(r.dataset_id, r.split) for r in read_datasets(spark, [plain]).collect()} == {("old", "test")}


def test_summary_files(spark):
    rows = [("Mus musculus", 1), ("unknown", 2), (None, 3), ("", 4), ("Homo sapiens", 5)]
    summary = spark.createDataFrame(rows, "organism string, n int")
    path = scratch_path(spark, "summary")
    write_summary(summary, path, "TSV")
    assert spark.read.option("sep", "\t").option("header", True).csv(path).count() == 5
    with pytest.raises(ValueError):
        write_summary(summary, path, "xlsx")
    path = scratch_path(spark, "organisms")
    write_by_organism(summary, path)
    assert sorted(r.organism_key for r in spark.read.option("header", True).csv(path).collect()) == [
        "homo_sapiens",
        "mus_musculus",
    ]


MB = 1024 * 1024


def test_size_limit_accepts_the_exact_size(spark):
    rows = [("/d/small file.h5ad", 100 * MB), ("/d/edge.h5ad", 12000 * MB), ("/d/over.h5ad", int(12000.01 * MB))]
    files = spark.createDataFrame(rows, "path string, length bigint")
    assert filter_by_size(files, 12000.0).count() == 2 and filter_by_size(files, None).count() == 3
    outputs = spark.createDataFrame(
        [("/out/small_file/test/chunk_0000.parquet", 1), ("/out/edge/chunk_0.parquet", 1)], "path string, length bigint"
    )
    assert sorted(r.dataset_name for r in filter_unfinished(files, outputs).collect()) == ["edge", "over"]
    assert sorted(r.dataset_name for r in filter_unfinished(files, outputs, skip_split=True).collect()) == ["over", "small_file"]
    plan = {r.dataset_name: (r.action, r.message) for r in plan_batch(files, outputs, 12000.0).collect()}
    assert plan == {
        "small_file": ("skip", "Output files already exist"),
        "edge": ("run", None),
        "over": ("skip", "skipped (file too large: 12000.01 MB > 12000.0 MB)"),
    }
    assert {r.action for r in plan_batch(files, None).collect()} == {"run"}


def test_file_listing(spark, tmp_path):
    os.makedirs(tmp_path / "train")
    (tmp_path / "train" / "a.parquet").write_bytes(b"x" * 2048)
    (tmp_path / "b.txt").write_bytes(b"y")
    files = list_files(spark, str(tmp_path), "*.parquet")
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in files.collect()] == [("a.parquet", 2048)]
    assert storage_by(files.withColumn("split", F.lit("train")), "split").first().bytes == 2048
    assert older_than(files, 1).count() == 0
    assert older_than(files, 1, F.current_timestamp() + F.make_dt_interval(F.lit(2))).count() == 1


def test_batch_goes_on_after_a_failure(spark):
    def process(name):
        if name == "bad":
            raise ValueError("broken input")
        return f"/out/{name}"

    planned = spark.createDataFrame([("a", "run", None), ("b", "run", None), ("c", "run", None), ("d", "skip", "why")], "dataset_name string, action string, message string")
    built = spark.createDataFrame([("a",), ("a",)], "dataset_id string")
    emptied = spark.createDataFrame([("c",)], "dataset_id string")
    rows = {tuple(r) for r in batch_report(planned, built, emptied).collect()}
    assert rows == {
        ("a", "SUCCESS", 2, "Successfully processed"),
        ("b", "FAILED", 0, "No rows were built"),
        ("c", "SUCCESS", 0, "Successfully processed"),
        ("d", "SKIPPED", 0, "why"),
    }
    skipped = spark.createDataFrame([("old", "Output files already exist")], "dataset_name string, message string")
    report = run_batch(spark, ["good", "bad", "fine"], process, skipped)
    found = {r.dataset_name: (r.status, r.output_path, r.message) for r in report.collect()}
    assert found == {
        "good": ("SUCCESS", "/out/good", "Successfully processed"),
        "bad": ("FAILED", "", "CRASH: broken input"),
        "fine": ("SUCCESS", "/out/fine", "Successfully processed"),
        "old": ("SKIPPED", "", "Output files already exist"),
    }
    assert tuple(run_totals(report).first()) == (4, 2, 1, 1)


@pytest.fixture
def tables(spark):
    obs = spark.createDataFrame(
        [(f"d{i % 2}", i, f"p{i % 6}", None if i == 5 else "lung", f"{20 + i % 6}-year-old" if i % 7 else "unknown") for i in range(60)],
        "dataset_id string, cell_id bigint, donor_id string, tissue string, development_stage string",
    )
    var = spark.createDataFrame(
        [(f"d{d}", i, f"ENSG{i}", f"F{i}" if i % 3 else f"ENSG{i}") for d in range(2) for i in range(8)],
        "dataset_id string, gene_idx bigint, ensembl_gene_id string, feature_name string",
    )
    expr = spark.createDataFrame(
        [(f"d{i % 2}", i, g, float((i * g) % 5 + 1)) for i in range(60) for g in range(8) if (i + g) % 2 and i != 9],
        "dataset_id string, cell_id bigint, gene_idx bigint, value double",
    )
    hgnc = spark.createDataFrame([("ENSG1", "SYM1", 1), ("ENSG2", "SYM2", 2)], "ensembl_gene_id string, symbol string, rank int")
    lists = spark.createDataFrame([("l", "SYM1"), ("l", "F4")], "list_name string, symbol string")
    return obs, var, expr, hgnc, lists


def rows_of(df):
    return {r["cell_id"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("zeros", [True, False])
def test_build_is_the_same_from_long_and_array_form(spark, tables, zeros):
    from cellspark.operators.sentences import to_sparse

    obs, var, expr, hgnc, lists = tables
    options = BuildOptions(top_n=3, list_names=("l",), include_zeros=zeros, test_size=0.3)
    sparse = to_sparse(expr, ["dataset_id", "cell_id"])
    from_long = rows_of(build_dataset(obs, var, expr, hgnc, None, lists, options))
    clustered = BuildOptions(top_n=3, list_names=("l",), include_zeros=zeros, test_size=0.3, cluster_output=True)
    from_arrays = rows_of(build_dataset(obs, var, sparse, hgnc, None, lists, clustered))
    assert from_long == from_arrays
    together = obs.join(sparse, ["dataset_id", "cell_id"], "left")
    assert rows_of(build_dataset(together, var, None, hgnc, None, lists, options)) == from_long
    assert set(from_long) == {i for i in range(60) if i % 7}
    words = from_long[9]["gene_sentence_all"].split()
    assert words == (["F7", "F5", "F4", "SYM2", "SYM1"] if zeros else [])
    assert {w for r in from_long.values() for w in r["gene_sentence_l"].split()} <= {"SYM1", "F4"}
    assert all(r["tissue"] in ("lung", "nan") for r in from_long.values())


def test_first_symbol_of_the_table_wins(spark, tables):
    obs, var, expr, _, _ = tables
    rows = [("ENSG1", "ZZZ", 1), ("ENSG1", "AAA", 2)]
    symbols = spark.createDataFrame(rows, "ensembl_gene_id string, symbol string, table_row long")
    built = build_dataset(obs, var, expr, symbols, options=BuildOptions(top_n=None, skip_split=True))
    words = {w for r in built.collect() for w in r["gene_sentence_all"].split()}
    assert "ZZZ" in words and "AAA" not in words


def test_build_without_split_or_age_filter(spark, tables):
    obs, var, expr, hgnc, lists = tables
    options = BuildOptions(top_n=None, skip_split=True, filter_by_age=False, use_hgnc=False, include_all=True)
    built = build_dataset(obs, var, expr, options=options)
    assert built.count() == 60 and "split" not in built.columns and "gene_sentence_all" in built.columns
    converted = convert_dataset(obs, var, expr, hgnc, options=BuildOptions(top_n=2))
    assert converted.count() == 60 and "age" not in converted.columns
    empty = build_dataset(obs.limit(0), var, expr, hgnc, options=BuildOptions(top_n=2))
    assert empty.count() == 0 and {"age", "split", "gene_sentence_2"} <= set(empty.columns)


def test_metadata_extraction(spark, tables):
    obs = tables[0].withColumn("organism", F.lit("Homo sapiens"))
    found = extract_metadata(obs, ["cell_id", "development_stage", "absent"], dataset_id="one")
    assert found.columns == ["cell_id", "development_stage", "age_years", "age_months", "dataset_id"]
    assert found.filter("age_years IS NULL").count() == 9
    assert extract_metadata(obs, ["tissue"]).filter("age_years IS NOT NULL").count() == 0
    assert extract_metadata(obs).filter("age_months IS NOT NULL").count() == 0
    assert extract_metadata(obs, ["tissue"], extract_age=False).columns == ["tissue"]
    with pytest.raises(ValueError):
        extract_metadata(obs, ["absent"])


def test_stored_metadata_and_summaries(spark, tables):
    obs = tables[0].withColumn("organism", F.when(F.col("dataset_id") == "d0", "Homo sapiens").otherwise("Mus musculus"))
    root = scratch_path(spark, "meta")
    stored = store_metadata(extract_metadata(obs), f"{root}/meta", f"{root}/summary", "tsv")
    assert stored.count() == 60
    summary = spark.read.option("sep", "\t").option("header", True).csv(f"{root}/summary")
    assert {(r.dataset_id, r.total_cells) for r in summary.collect()} == {("d0", "30"), ("d1", "30")}
    store_species_summary(stored, f"{root}/species")
    everything = spark.read.option("header", True).csv(f"{root}/species/all_datasets_summary")
    assert [r.dataset_id for r in everything.collect()] == ["d0", "d1"]
    mouse = spark.read.option("header", True).csv(f"{root}/species/by_organism/organism_key=mus_musculus")
    assert [r.dataset_id for r in mouse.collect()] == ["d1"]
    with pytest.raises(ValueError):
        store_metadata(stored, f"{root}/other", f"{root}/s", "xlsx")


def test_resplit(spark, tables):
    cells = tables[0].withColumn("age", F.when(F.col("cell_id") > 5, F.col("cell_id") % 6 + 20.0))
    result = resplit_dataset(cells, ["cell_id"], test_size=0.3)
    assert split_leaks(result.cells, "donor_id").count() == 0
    assert result.filtering.first().cells_discarded == 6
    assert result.sides.first().total_cells == 54
    assert result.donors.first().total_donors == 6
    assert sum(r.cells for r in result.ages_by_side.collect()) == 54
    assert result.thin_ages.count() == 0


def test_ingest_keeps_donors_on_their_side(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "cell_id bigint, donor_id string, age double"

    def add(start, donors):
        rows = [(start + i, f"p{i % donors}", 30.0 + i % donors) for i in range(200)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        fields = spark.createDataFrame([], schema).schema
        ingest_new_files(spark, source, fields, target, progress, lambda df: df, test_size=0.25)
        return {r.cell_id: (r.donor_id, r.split) for r in read_ingested(spark, target).collect()}

    add(0, 20)
    first = run()
    assert run() == first and len(first) == 200
    add(1000, 40)
    second = run()
    assert len(second) == 400 and {k: second[k] for k in first} == first
    sides = {}
    for donor, side in second.values():
        assert sides.setdefault(donor, side) == side
    assert len(sides) == 40 and 0 < sum(s == "test" for s in sides.values()) < 20


def test_build_from_one_table_moves_no_cells(spark, tables):
    """Arrays beside the metadata and a split by donor hash: only the gene rows are shuffled, then broadcast."""
    from cellspark.operators.sentences import to_sparse

    obs, var, expr, hgnc, lists = tables
    together = obs.join(to_sparse(expr, ["dataset_id", "cell_id"]), ["dataset_id", "cell_id"])
    path = scratch_path(spark, "cells")
    together.write.parquet(path)
    options = BuildOptions(top_n=3, list_names=("l",), stratify_by_age=False)
    built = build_dataset(spark.read.parquet(path), var, None, hgnc, None, lists, options)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning(dataset_id" in plan and "SortMergeJoin" not in plan
    assert set(r.split for r in built.collect()) <= {"train", "test"}


def test_ingest_of_empty_batches_and_known_donors(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "cell_id bigint, donor_id string, age double"
    fields = spark.createDataFrame([], schema).schema

    def add_and_run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        ingest_new_files(
            spark, source, fields, target, progress, lambda df: df.filter("age IS NOT NULL"), test_size=0.3
        )
        return {r.cell_id: r.split for r in read_ingested(spark, target).collect()}

    assert add_and_run([(1, "a", None)]) == {}
    first = add_and_run([(10 + i, f"p{i % 10}", 30.0) for i in range(50)])
    assert len(first) == 50
    again = add_and_run([(100 + i, f"p{i % 10}", 40.0) for i in range(50)])
    assert len(again) == 100 and all(again[100 + i] == first[10 + i] for i in range(50))


def test_ingest_does_not_depend_on_batches(spark, tmp_path):
    schema = "cell_id bigint, donor_id string, age double"
    source = str(tmp_path / "in")
    rows = [(i, f"p{i % 400}", 30.0) for i in range(2000)]
    spark.createDataFrame(rows, schema).repartition(8, "donor_id").write.parquet(source)
    found = []
    for files in (1, 1000):
        out, progress = str(tmp_path / f"out{files}"), str(tmp_path / f"progress{files}")
        fields = spark.createDataFrame([], schema).schema
        ingest_new_files(spark, source, fields, out, progress, lambda df: df, test_size=0.2, files_per_batch=files)
        found.append({r.cell_id: r.split for r in read_ingested(spark, out).collect()})
    assert found[0] == found[1] and len(found[0]) == 2000
    assert 0.15 < sum(s == "test" for s in found[0].values()) / 2000 < 0.25


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        scratch_path(Session(), "x")


def test_names_with_dots_and_blanks(spark, tables):
    obs, var, expr, hgnc, _ = tables
    obs = obs.withColumnRenamed("tissue", "tissue. type")
    lists = spark.createDataFrame([("my.list-1", "SYM1"), ("b c", "F4")], "list_name string, symbol string")
    for zeros in (True, False):
        options = BuildOptions(top_n=3, include_zeros=zeros)
        built = build_dataset(obs, var, expr, hgnc, None, lists, options)
        assert {"gene_sentence_my.list-1", "gene_sentence_b c", "tissue. type"} <= set(built.columns)
        rows = built.collect()
        assert {r["gene_sentence_my.list-1"] for r in rows} == ({"SYM1"} if zeros else {"", "SYM1"})
        assert {r["tissue. type"] for r in rows} == {"lung", "nan"}
    assert extract_metadata(obs, ["tissue. type"]).columns[0] == "tissue. type"


def test_small_files_are_measured_as_they_are_dealt(spark, tmp_path):
    path, target = str(tmp_path / "small"), 0.05
    write_by_size(spark.range(200_000).select("id", F.sha2((F.col("id") * 7919 % 2000).cast("string"), 256).alias("word")), path, target)
    shares = [r["length"] / (target * 1024 * 1024) for r in list_files(spark, path, "*.parquet").collect()]
    assert max(shares) < 1.3 and min(shares) > 0.5
    assert spark.read.parquet(path).count() == 200_000


def test_files_of_a_table_folder_are_listed_under_its_name(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "more" / "part.parquet"))
    names = list_files(spark, str(tmp_path), "*.parquet").select(entry_of(str(tmp_path), F.col("path")).alias("name"))
    assert {r["name"]: r["n"] for r in names.groupBy("name").agg(F.count("*").alias("n")).collect()} == {"orders.parquet": 3, "more": 1}


def test_inventory_of_table_folders(spark, tmp_path):
    from workload import QUERIES

    for table, rows in (("orders", 10), ("part", 4), ("empty", 0)):
        spark.range(rows).repartition(3).write.parquet(str(tmp_path / "sf" / f"{table}.parquet"))
    found = QUERIES["s9_file_inventory"](spark, str(tmp_path / "sf")).collect()
    assert sorted(tuple(r) for r in found) == [("empty", 0, True), ("orders", 10, True), ("part", 4, True)]
