import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspark.operators import columns as c
from cellspark.operators.ages import age_range_violations, null_age_sample, null_age_stats, thin_ages, with_age
from cellspark.operators.ages import with_age_by_mode, with_species_ages
from cellspark.operators.genes import map_genes, map_genes_without_table, mapping_stats, symbol_checks
from cellspark.operators.profile import nonzero_columns, nonzero_genes, null_counts, table_profile, top_genes_of_cell
from cellspark.operators.publications import flatten_collections, join_publications, match_rate, publication_text
from cellspark.operators.runlogs import log_advice, log_metrics
from cellspark.operators.sets import diagonal_concat, lost_keys, shared_keys
from cellspark.operators.summaries import dataset_summaries, distinct_with_null, species_summary, top_values

SYMBOLS = "ensembl_gene_id string, symbol string, rank int"


def test_symbol_fallback(spark):
    var = spark.createDataFrame(
        [(0, "ENSG1", "F1"), (1, "ENSG2", "F2"), (2, "ENSG3", "ENSG3"), (3, "ENSG4", None), (4, "ENSG5", "F5")],
        "gene_idx int, ensembl_gene_id string, feature_name string",
    )
    hgnc = spark.createDataFrame(
        [("ENSG1", "B", 2), ("ENSG1", "A", 1), ("ENSG5", None, 0), (None, "X", 1), ("ENSG9", "N", 1)], SYMBOLS
    )
    mapped = map_genes(var, hgnc, ["rank"])
    found = {r.gene_idx: (r.symbol, r.mapped_via) for r in mapped.collect()}
    assert found == {
        0: ("A", "hgnc"),
        1: ("F2", "feature_name"),
        2: ("ENSG3", "gene_id"),
        3: ("ENSG4", "gene_id"),
        4: ("F5", "feature_name"),
    }
    stats = mapping_stats(mapped).first().asDict()
    assert (stats["mapped_via_hgnc"], stats["fallback_percentage"], stats["unmapped_percentage"]) == (1, 40.0, 40.0)
    plain = map_genes(var.drop("feature_name"), hgnc.withColumnsRenamed({"symbol": "Approved symbol"}), ["rank"])
    assert {r.gene_idx: r.symbol for r in plain.collect()}[1] == "ENSG2"
    assert mapping_stats(mapped.limit(0)).first().hgnc_mapping_percentage == 0.0


def test_symbol_check_looks_at_all_names(spark):
    rows = [("a", i, f"ENSG{i}", f"g{i}" if i >= 140 or i == 3 else f"ENSG{i}") for i in range(300)]
    rows += [("b", i, f"ENSG{i}", f"g{i}" if i < 140 else f"ENSG{i}") for i in range(300)]
    var = spark.createDataFrame(rows, "dataset_id string, gene_idx int, ensembl_gene_id string, feature_name string")
    found = {r.dataset_id: (r.var_names_are_symbols, r.feature_names_are_symbols) for r in symbol_checks(var).collect()}
    assert found == {"a": (False, True), "b": (False, False)}
    symbols = {(r.dataset_id, r.gene_idx): r.symbol for r in map_genes_without_table(var).collect()}
    assert symbols["a", 3] == "g3" and symbols["b", 3] == "ENSG3" and len(symbols) == 600
    plain = map_genes_without_table(var.drop("feature_name")).collect()
    assert {r.symbol for r in plain} == {f"ENSG{i}" for i in range(300)}
    assert not any(r.feature_names_are_symbols for r in symbol_checks(var.drop("feature_name")).collect())
    holes = var.withColumn("feature_name", F.when(F.col("gene_idx") != 200, F.col("feature_name")))
    assert {(r.dataset_id, r.gene_idx): r.symbol for r in map_genes_without_table(holes).collect()}["a", 200] == "ENSG200"


def test_fields_and_types(spark):
    df = spark.createDataFrame([("1", "x", None), ("y", None, None)], "a string, b string, index string")
    assert c.select_fields(df).columns == ["a", "b"]
    assert c.select_fields(df, ["b", "zz"]).columns == ["b"] and c.missing_fields(df, ["b", "zz"]) == ["zz"]
    with pytest.raises(ValueError):
        c.select_fields(df, ["zz"])
    encodings = {"a": ("nullable-integer", None), "s": ("array", "O"), "f": ("array", "f"), "g": ("dict", None)}
    schema = c.schema_from_encodings(encodings)
    assert [(f.name, f.dataType) for f in schema] == [("a", T.LongType()), ("s", T.StringType()), ("f", T.DoubleType())]
    assert [r.a for r in c.cast_to_schema(df, schema).collect()] == [1, None]
    assert [tuple(r) for r in c.fill_missing_text(df.select("b")).collect()] == [("x",), ("nan",)]
    typed = c.type_untyped_columns(df.select("a").withColumn("f", F.lit(None)), schema)
    assert dict(typed.dtypes)["f"] == "double"
    assert c.first_present(df, ["q", "b", "a"]) == "b"


def test_nullable_columns_keep_their_nulls(spark):
    df = spark.createDataFrame(
        [(1, False, True, False), (9, True, False, True), (3, False, False, False)],
        "v bigint, v_mask boolean, b boolean, b_mask boolean",
    )
    rows = df.select(c.decode_mask(F.col("v"), F.col("v_mask")), c.decode_mask(F.col("b"), F.col("b_mask"))).collect()
    assert [tuple(r) for r in rows] == [(1, True), (None, None), (3, False)]


def test_codes(spark):
    df = spark.createDataFrame([(0, ["a", "b"]), (1, ["a", "b"]), (-1, ["a"]), (5, ["a"]), (0, None)], "c int, d array<string>")
    assert [r[0] for r in df.select(c.decode_codes(F.col("c"), F.col("d"))).collect()] == ["a", "b", None, None, None]


def test_preloaded_columns(spark):
    rows = spark.range(4).withColumnRenamed("id", "i")
    stored = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "at int, v string")
    found = c.attach_scalar(c.attach_by_position(rows, "i", stored, "name"), spark.sql("SELECT 7 AS v"), "seven")
    assert sorted(tuple(r) for r in found.collect()) == [(0, "x", 7), (1, "y", 7), (2, "z", 7), (3, None, 7)]


def test_sample_rows_and_keep_first(spark):
    df = spark.createDataFrame([(i, "x" * 300, list(range(20))) for i in range(9)], "i int, t string, a array<int>")
    rows = c.sample_rows(df, ["i"]).collect()
    assert len(rows) == 5 and len(rows[0].t) == 214 and rows[0].a == list(range(8))
    nested = spark.sql("SELECT 1 AS i, array(named_struct('t', repeat('x', 300))) AS s, map('k', repeat('y', 300)) AS m, CAST(repeat('z', 300) AS BINARY) AS b")
    row = c.sample_rows(nested, ["i"]).first()
    assert (len(row.s[0].t), len(row.m["k"]), len(row.b)) == (214, 214, 200)
    pairs = spark.createDataFrame([("a", 2, None), ("a", 1, "first"), ("b", 3, "only")], "k string, o int, v string")
    assert sorted(tuple(r) for r in c.keep_first(pairs, ["k"], ["o"]).collect()) == [("a", 1, "first"), ("b", 3, "only")]


def test_diagonal_concat(spark):
    left = spark.sql("SELECT 1 AS id, 2 AS n, 3 AS m")
    right = spark.sql("SELECT 2 AS id, 2.5D AS n, 'text' AS m, true AS extra")
    both = diagonal_concat(left, right)
    assert dict(both.dtypes) == {"id": "int", "n": "double", "m": "string", "extra": "boolean"}
    assert sorted(tuple(r) for r in both.collect()) == [(1, 2.0, "3", None), (2, 2.5, "text", True)]


def test_key_sets(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    right = spark.createDataFrame([("b",)], "k string")
    assert [r.k for r in shared_keys(left, right, "k").collect()] == ["b"]
    assert sorted(r.k for r in lost_keys(left, "k", right).collect()) == ["a", "c"]


def test_ages(spark):
    schema = "organism string, development_stage string, age string, age_years double"
    rows = [
        ("Homo sapiens", "22-year-old", None, None),
        ("Homo sapiens", "22-year-old", None, 50.0),
        ("Homo sapiens", "24m", "3", None),
        ("Mus musculus", "24m", "3", None),
        ("Mus musculus", "adult", "3", None),
        ("Mus musculus", "adult", "old", None),
    ]
    df = spark.createDataFrame(rows, schema)
    found = [(r.age_years, r.age_months) for r in with_species_ages(df).collect()]
    assert found == [(22.0, None), (50.0, None), (None, None), (None, 24.0), (None, 3.0), (None, None)]
    free = with_species_ages(df.drop("organism", "age_years")).collect()
    assert [(r.age_years, r.age_months) for r in free][2] == (None, 24.0)
    assert [r.age for r in with_age(df).collect()][:4] == [22.0, 22.0, None, None]
    assert with_age(df.drop("development_stage")).select("age").distinct().collect()[0].age is None
    assert [r.age for r in with_age_by_mode(df, "species").collect()][3] == 2.0
    with pytest.raises(ValueError):
        with_age_by_mode(df, "days")


def test_age_statistics(spark):
    df = spark.createDataFrame([(i, "x", None if i < 3 else float(i % 2)) for i in range(12)], "i int, development_stage string, age double")
    assert null_age_stats(df).first().asDict() == {
        "cells_before_filtering": 12,
        "cells_after_filtering": 9,
        "cells_discarded": 3,
        "discard_percentage": 25.0,
    }
    assert null_age_stats(df.limit(0)).first().discard_percentage == 0.0
    assert [r.i for r in null_age_sample(df, "i").collect()] == [0, 1, 2]
    assert [(r.age, r.cells) for r in thin_ages(df, 0.2).collect()] == [(0.0, 4)]
    assert thin_ages(df, 0).count() == 0
    assert age_range_violations(df.withColumn("age", F.col("age") * 151)).first().out_of_range == 5


def test_publications(spark):
    nested = spark.createDataFrame(
        [
            ("c1", None, None, None, "n", None, [("d1", "x"), ("", "d2"), (None, None)]),
            ("c2", "T", "10/1", "D", "n", "e", [(None, "d1")]),
        ],
        "collection_id string, name string, doi string, description string, contact_name string, contact_email string, "
        "datasets array<struct<id:string,dataset_id:string>>",
    )
    flat = flatten_collections(nested)
    assert sorted((r.dataset_id, r.collection_id, r.title, r.doi) for r in flat.collect()) == [
        ("d1", "c1", "", None),
        ("d1", "c2", "T", "10/1"),
        ("d2", "c1", "", None),
    ]
    cells = spark.createDataFrame([("d1",), ("d2",), ("d3",), (None,)], "dataset_id string")
    joined = join_publications(cells, flat)
    assert joined.count() == 5
    assert match_rate(joined).first().asDict() == {"total_rows": 5, "rows_with_metadata": 3, "match_percentage": 60.0}
    assert {r.publication_doi for r in publication_text(joined).collect()} == {"nan", "10/1"}
    assert join_publications(joined, flat) is joined
    with pytest.raises(ValueError):
        join_publications(spark.range(1), flat)


def test_dataset_summaries(spark):
    rows = [
        ("d1", "Homo sapiens", "p1", "lung", None, 30.0, None),
        ("d1", "Homo sapiens", "p1", "liver", "10x", 30.0, None),
        ("d1", "Homo sapiens", None, "lung", "10x", 41.5, None),
        ("d1", None, "p2", "lung", "10x", None, 3.0),
        ("d2", "Mus musculus", "m", None, None, None, 24.0),
    ]
    meta = spark.createDataFrame(
        rows, "dataset_id string, organism string, subject_id string, organ string, assay string, age_years double, age_months double"
    )
    found = {r.dataset_id: r for r in dataset_summaries(meta).collect()}
    first, second = found["d1"], found["d2"]
    assert (first.total_cells, first.organism, first.unique_donors) == (4, "Homo sapiens", 3)
    assert (first.age_years_min, first.age_years_max, first.age_years_mean) == (30.0, 41.5, 33.83)
    assert (first.unique_tissues, first.tissues) == (2, "lung: 3, liver: 1")
    assert (first.unique_assays, first.assays) == (2, "10x: 3")
    assert first.unique_ages_years == "30.0: 2, 41.5: 1"
    assert (first.unique_cell_types, first.cell_types, first.age_months_min, first.cells_with_age_months) == (None,) * 4
    assert (second.unique_tissues, second.tissues, second.unique_ages_years) == (1, None, None)
    assert (second.age_months_mean, second.cells_with_age_months, second.unique_ages_months) == (24.0, 1, "24.0: 1")
    assert second.cells_with_age_years == 0 and second.age_years_mean is None
    assert [r.dataset_id for r in species_summary(meta).collect()] == ["d1", "d2"]
    bare = dataset_summaries(meta.select("dataset_id")).orderBy("dataset_id").collect()
    assert [(r.total_cells, r.organism, r.unique_donors, r.cells_with_age_years) for r in bare] == [
        (4, "Homo sapiens", None, 0),
        (1, "Homo sapiens", None, 0),
    ]
    assert dataset_summaries(meta.limit(0)).columns == dataset_summaries(meta).columns


def test_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "v int")
    assert df.agg(distinct_with_null("v").alias("n")).first().n == 2
    assert df.limit(0).agg(distinct_with_null("v").alias("n")).first().n == 0
    assert [tuple(r) for r in top_values(df, "v", 1).collect()] == [(1, 2)]
    assert null_counts(df).first().v == 1
    assert [tuple(r) for r in nonzero_columns(df, ["v"]).collect()] == [("v", 2, 66.67)]
    assert [tuple(r) for r in table_profile(df).collect()] == [("v", "int", 3, 2, 1.0, 1.0, 1.0, 0.0, 1.0, 1.0, 1.0)]
    cells = spark.createDataFrame([(1, [0.0, 2.0, 3.0])], "c int, expression array<double>")
    assert tuple(nonzero_genes(cells, ["c"]).first()) == (1, 3, 2, 66.67)


def test_top_genes_of_cell_by_either_id(spark):
    rows = [("c1", "j1", i, f"g{i}", float(i)) for i in range(5)] + [("c2", "j2", 0, "g0", 1.0)]
    expr = spark.createDataFrame(rows, "cell_id string, joinid string, gene_idx int, symbol string, value double")
    for wanted in ("c1", "j1"):
        found = top_genes_of_cell(expr, "cell_id", wanted, alternative="joinid").collect()
        assert [(r.symbol, r["value"]) for r in found] == [
            ("g4", 4.0),
            ("g3", 3.0),
            ("g2", 2.0),
        ]


def test_log_metrics(spark):
    schema = "message_type string, timestamp double, total_cells bigint, cells_with_null_age bigint, column string"
    rows = [
        ("age_extraction_summary", 1.0, 10, 1, None),
        ("age_extraction_summary", 2.0, 20, 5, None),
        ("warning_missing_column", 3.0, None, None, "tissue"),
        ("warning_missing_column", 3.5, None, None, "tissue"),
        ("other", 4.0, 99, 99, None),
    ]
    found = log_advice(log_metrics(spark.createDataFrame(rows, schema))).first()
    assert (found.total_cells, found.cells_with_null_age, found.genes_total) == (20, 5, 0)
    assert found.missing_columns == ["tissue", "tissue"] and found.too_many_null_ages and not found.too_many_unmapped_genes


def test_collections_from_text_and_column_types(spark):
    from cellspark.operators.profile import column_types
    from cellspark.operators.publications import parse_collections

    line = '{"collection_id": "c", "name": "N", "doi": null, "datasets": [{"id": "d"}]}'
    rows = parse_collections(spark.createDataFrame([(line,)], "value string"))
    assert [(r.dataset_id, r.collection_id, r.title, r.doi, r.contact_name) for r in rows.collect()] == [
        ("d", "c", "N", None, "")
    ]
    assert column_types(rows)[:2] == [("dataset_id", "string"), ("collection_id", "string")]
