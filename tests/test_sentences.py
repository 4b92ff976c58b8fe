import math
import random

import pytest
from pyspark.sql import functions as F

from cellspark.operators import sentences as module
from cellspark.operators.genes import flag_lists
from cellspark.operators.sentences import (
    densify,
    rank_genes,
    sentence_quality,
    sentences_from_arrays,
    sentences_from_long,
    to_long,
    to_sparse,
    top_sentences,
)


def brute(values, names, top_n, lists):
    """Sentences of one cell: NaN first, value descending, ties by index descending, no ENS names."""

    def key(i):
        v = 0.0 if values[i] is None else values[i]
        return (math.inf, 1, i) if math.isnan(v) else (v, 0, i)

    order = [names[i] for i in sorted(range(len(values)), key=key, reverse=True) if not names[i].startswith("ENS")]
    found = {"gene_sentence_all": " ".join(order), f"gene_sentence_{top_n}": " ".join(order[:top_n])}
    return found | {f"gene_sentence_{n}": " ".join(g for g in order if g in s) for n, s in lists.items()}


def genes_table(spark, names, lists, dataset="d"):
    genes = spark.createDataFrame(
        [(dataset, i, n) for i, n in enumerate(names)], "dataset_id string, gene_idx bigint, symbol string"
    )
    rows = [(n, g) for n, s in lists.items() for g in s] or [("none", "none")]
    return flag_lists(genes, spark.createDataFrame(rows, "list_name string, symbol string"), list(lists))


def as_dict(df):
    return {r["cell_id"]: {k: v for k, v in r.asDict().items() if k.startswith("gene_")} for r in df.collect()}


NAMES = ["A", "ENSG1", "C", "D", "E"]


def test_order_and_ties(spark):
    rows = [(1, i, v, NAMES[i]) for i, v in enumerate([0.0, 3.0, float("nan"), 3.0, 1.0])]
    expr = spark.createDataFrame(rows, "cell_id int, gene_idx int, value double, symbol string")
    genes = genes_table(spark, NAMES, {})
    built = sentences_from_long(expr.drop("symbol").withColumn("dataset_id", F.lit("d")), genes, ["cell_id"], 2)
    assert as_dict(built)[1] == {"gene_sentence_all": "C D E", "gene_sentence_2": "C D"}
    assert as_dict(top_sentences(expr, ["cell_id"], 2))[1] == {"gene_sentence_2": "C D"}
    assert as_dict(top_sentences(expr, ["cell_id"], 9))[1] == {"gene_sentence_9": "C D E A"}
    assert as_dict(top_sentences(expr, ["cell_id"], 0))[1] == {"gene_sentence_0": ""}


def test_edges(spark):
    expr = spark.createDataFrame(
        [(1, 0, 2.0, "ENSG1"), (1, 1, 1.0, "ENSG2"), (2, 0, 1.0, "a"), (2, 1, None, "A")],
        "cell_id int, gene_idx int, value double, symbol string",
    )
    keyed = expr.withColumn("dataset_id", F.when(F.col("cell_id") == 1, "x").otherwise("y"))
    genes = keyed.select("dataset_id", F.col("gene_idx").cast("bigint").alias("gene_idx"), "symbol")
    found = as_dict(sentences_from_long(keyed.drop("symbol"), genes, ["cell_id"], None))
    assert found == {1: {"gene_sentence_all": ""}, 2: {"gene_sentence_all": "a"}}
    assert as_dict(top_sentences(expr, ["cell_id"], 5))[1] == {"gene_sentence_5": ""}
    listed = genes.withColumn("in_up", F.col("symbol") == "a").withColumn("in_empty", F.lit(False))
    found = as_dict(sentences_from_long(keyed.drop("symbol"), listed, ["cell_id"], 0, ["up", "empty"]))
    assert found[2] == {
        "gene_sentence_all": "a",
        "gene_sentence_0": "",
        "gene_sentence_up": "a",
        "gene_sentence_empty": "",
    }


def random_cells(seed, cells, n_genes):
    rng = random.Random(seed)
    pool = [0.0, 0.0, 0.0, 1.0, 2.0, 2.0, 3.5, -1.0, float("nan"), None]
    return {c: [rng.choice(pool) for _ in range(n_genes)] for c in range(cells)}


@pytest.fixture
def fixture(spark):
    # "TWIN" stands for two genes, as a symbol can.
    names = [("ENSG%d" % i) if i % 4 == 0 else ("TWIN" if i in (3, 5) else f"g{i}") for i in range(23)]
    lists = {"few": {"g1", "g2", "TWIN", "ENSG4"}, "other": {"g7", "g22", "absent"}, "none": set()}
    cells = random_cells(1, 30, len(names))
    cells[30] = [0.0] * len(names)
    return names, lists, cells


def sparse_cells(spark, cells):
    rows = [
        ("d", c, [i for i, v in enumerate(vs) if v != 0.0 or i % 5 == 0], [v for i, v in enumerate(vs) if v != 0.0 or i % 5 == 0])
        for c, vs in cells.items()
    ]
    return spark.createDataFrame(rows, "dataset_id string, cell_id int, indices array<int>, values array<double>")


@pytest.mark.parametrize("broadcast", [True, False])
def test_zero_filled_and_dense_match_brute_force(spark, fixture, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
        monkeypatch.setattr("cellspark.operators.joins.ROWS_PER_COPY", 4)
    names, lists, cells = fixture
    expected = {c: brute(vs, names, 4, lists) for c, vs in cells.items()}
    genes = genes_table(spark, names, lists)
    sparse = sentences_from_arrays(sparse_cells(spark, cells), genes, ["cell_id"], 4, list(lists))
    assert as_dict(sparse) == expected
    dense = spark.createDataFrame(
        [("d", c, vs) for c, vs in cells.items()], "dataset_id string, cell_id int, expression array<double>"
    )
    assert as_dict(sentences_from_arrays(dense, genes, ["cell_id"], 4, list(lists))) == expected


def brute_stored(values, names, top_n, lists):
    """Sentences of one cell from what is neither zero nor missing."""
    kept = [i for i, v in enumerate(values) if v is not None and v != 0.0]
    return brute([values[i] for i in kept], [names[i] for i in kept], top_n, lists)


def test_stored_values_only(spark, fixture):
    names, lists, cells = fixture

    def stored(vs):
        return brute_stored(vs, names, 4, lists)

    expected = {c: stored(vs) for c, vs in cells.items()}
    genes = genes_table(spark, names, lists)
    built = sentences_from_arrays(
        sparse_cells(spark, cells), genes, ["cell_id"], 4, list(lists), include_zeros=False
    )
    assert as_dict(built) == expected


def test_long_form_matches_brute_force(spark, fixture):
    names, lists, cells = fixture
    rows = [("d", c, i, v) for c, vs in cells.items() for i, v in enumerate(vs)]
    expr = spark.createDataFrame(rows, "dataset_id string, cell_id int, gene_idx bigint, value double")
    built = sentences_from_long(expr, genes_table(spark, names, lists), ["cell_id"], 4, list(lists))
    assert as_dict(built) == {c: brute_stored(vs, names, 4, lists) for c, vs in cells.items()}


def test_cells_of_unknown_datasets_and_without_values_are_kept(spark):
    genes = genes_table(spark, ["A", "B"], {})
    cells = spark.createDataFrame(
        [("d", 1, None, None), ("x", 2, [0], [1.0])],
        "dataset_id string, cell_id int, indices array<int>, values array<double>",
    )
    found = as_dict(sentences_from_arrays(cells, genes, ["cell_id"], 1))
    assert found[1] == {"gene_sentence_all": "B A", "gene_sentence_1": "B"}
    assert found[2] == {"gene_sentence_all": "", "gene_sentence_1": ""}


def test_rank_with_limit_keeps_usable_genes_of_every_cell(spark):
    rows = [(c, i, float(i % 3), f"{'ENS' if i % 2 else 'g'}{i}") for c in (1, 2) for i in range(10)]
    expr = spark.createDataFrame(rows, "cell_id int, gene_idx int, value double, symbol string")
    full = {(r.cell_id, r.rank): r.symbol for r in rank_genes(expr, ["cell_id"]).collect()}
    cut = {(r.cell_id, r.rank): r.symbol for r in rank_genes(expr, ["cell_id"], 3).collect()}
    assert cut == {k: v for k, v in full.items() if k[1] <= 3}
    assert [full[1, r] for r in range(1, 6)] == ["g8", "g2", "g4", "g6", "g0"]


def test_forms_convert(spark):
    expr = spark.createDataFrame([(1, 3, 2.0), (1, 0, 1.0), (2, 2, 5.0)], "cell_id int, gene_idx int, value double")
    sparse = to_sparse(expr, ["cell_id"])
    assert {r.cell_id: (r.indices, r["values"]) for r in sparse.collect()} == {1: ([0, 3], [1.0, 2.0]), 2: ([2], [5.0])}
    assert sorted(map(tuple, to_long(sparse, ["cell_id"]).collect())) == sorted(map(tuple, expr.collect()))
    stored = spark.createDataFrame(
        [(3, [], []), (4, [3, 1], [7.0, None])], "cell_id int, indices array<int>, values array<double>"
    )
    dense = densify(sparse.unionByName(stored).withColumn("n", F.lit(4)), "n")
    assert {r.cell_id: r.expression for r in dense.collect()} == {
        1: [1.0, 0.0, 0.0, 2.0],
        2: [0.0, 0.0, 5.0, 0.0],
        3: [0.0, 0.0, 0.0, 0.0],
        4: [0.0, 0.0, 0.0, 7.0],
    }


def test_quality(spark):
    df = spark.createDataFrame([("A B",), ("",), ("A ENSG12",)], "s string")
    assert sentence_quality(df, "s").first().asDict() == {
        "sentences": 3,
        "empty": 1,
        "with_ensembl_token": 1,
        "longest": 8,
    }


def test_gaps_in_gene_numbers(spark):
    genes = genes_table(spark, ["A", "B", "C"], {}).filter("gene_idx <> 1")
    cells = spark.createDataFrame(
        [("d", 1, [0, 2], [1.0, 5.0])], "dataset_id string, cell_id int, indices array<int>, values array<double>"
    )
    found = as_dict(sentences_from_arrays(cells, genes, ["cell_id"], 1, include_zeros=False))
    assert found == {1: {"gene_sentence_all": "C A", "gene_sentence_1": "C"}}
    cells = cells.withColumn("values", F.array(F.lit(0.0), F.lit(5.0)))
    assert as_dict(sentences_from_arrays(cells, genes, ["cell_id"], 1))[1]["gene_sentence_all"] == "C A"
    dense = cells.select("dataset_id", "cell_id", F.array(*[F.lit(x) for x in (1.0, 9.0, 2.0)]).alias("expression"))
    assert as_dict(sentences_from_arrays(dense, genes, ["cell_id"], 1))[1]["gene_sentence_all"] == "C A"
    with pytest.raises(ValueError):
        sentences_from_arrays(cells, genes.unionByName(genes), ["cell_id"], 1)


def test_cells_that_come_twice_keep_their_own_sentence(spark):
    genes = genes_table(spark, ["A", "B", "C"], {})
    cells = spark.createDataFrame(
        [("d", 1, [0, 2], [1.0, 5.0])] * 2, "dataset_id string, cell_id int, indices array<int>, values array<double>"
    )
    built = sentences_from_arrays(cells, genes, ["cell_id"], None, include_zeros=False)
    assert [r.gene_sentence_all for r in built.collect()] == ["C A", "C A"]


@pytest.mark.parametrize("lists", [("small",), tuple(f"l{i}" for i in range(17))])
def test_values_that_meet_genes_one_by_one_give_the_same_sentences(spark, monkeypatch, lists):
    names = [f"ENSG{i}" if i % 4 == 1 else f"G{i}" for i in range(40)]
    genes = genes_table(spark, names, {n: {f"G{g}" for g in range(i, 40, 3)} for i, n in enumerate(lists)})
    genes = genes.where("gene_idx % 7 <> 3")
    genes = genes.unionByName(genes.withColumn("dataset_id", F.lit("e")).withColumn("symbol", F.concat(F.lit("E"), "symbol")))
    some = random.Random(5)
    rows = [("de-"[c % 3], c, sorted(some.sample(range(40), c % 30)), c) for c in range(90)]
    rows = [(d, c, i, [some.choice([0.0, None, 1.0, 2.5, -1.0, math.nan]) for _ in i], "x") for d, c, i, _ in rows]
    rows += [("d", 7, *rows[7][2:4], "y"), (None, 90, [1, 2], [1.0, 2.0], "x"), ("d", 91, None, None, "x")]
    cells = spark.createDataFrame(rows, "dataset_id string, cell_id int, indices array<int>, values array<double>, other string").repartition(3)

    def built(**more):
        found = sentences_from_arrays(cells, genes, ["dataset_id", "cell_id"], 5, lists, include_zeros=False, **more)
        return sorted(map(str, found.collect()))

    packed = built()
    monkeypatch.setattr(module, "PANEL_BYTES", 0)
    assert built() == packed and len(packed) == len(rows)
    assert built(cluster_by=["dataset_id"]) == packed


def test_cells_do_not_meet_packed_rows_of_very_many_genes(spark):
    """Before, every cell met a row of 300,000 symbols."""
    genes = spark.range(300_000).selectExpr("'d' AS dataset_id", "id AS gene_idx", "concat('G', id) AS symbol")
    cells = spark.range(1000).selectExpr("'d' AS dataset_id", "id AS cell_id", "array(int(id), int(id + 1000)) AS indices", "array(1d, 2d) AS values")
    found = sentences_from_arrays(cells, genes, ["dataset_id", "cell_id"], 1, include_zeros=False)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "symbols" not in plan
    assert as_dict(found)[17] == {"gene_sentence_all": "G1017 G17", "gene_sentence_1": "G1017"}


@pytest.mark.parametrize("broadcast", [True, False])
def test_zero_filled_sentences_are_cut_out_of_ready_made_texts(spark, monkeypatch, broadcast):
    """Before, every gene of every cell was looked up by itself."""
    if not broadcast:
        monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    some = random.Random(3)
    names = [some.choice([f"G{i}", f"ENSG{i}", "TWIN", "", "two words", "Grün ", "x" * 70_000]) for i in range(330)]
    lists = {"few": {"TWIN", "G7", ""}, "none": set()}
    cells = {0: [0.0] * 330, 1: [1.0] * 330, 2: [-1.0] * 330}
    for c in range(3, 30):
        cells[c] = [some.choice([1.0, 2.0, -1.0, math.nan, None]) if some.random() < c / 60 else 0.0 for _ in names]
    found = sentences_from_arrays(sparse_cells(spark, cells), genes_table(spark, names, lists), ["cell_id"], 7, list(lists))
    assert "_pieces" in found._jdf.queryExecution().optimizedPlan().toString()
    assert as_dict(found) == {c: brute(vs, names, 7, lists) for c, vs in cells.items()}
