import hashlib

import pytest
from pyspark.sql import functions as F

from cellspark.functions.ages import age_in_months, age_in_years
from cellspark.functions.hashing import hash_uniform
from cellspark.functions.text import (
    dataset_id_from_path,
    has_ensembl_token,
    hms,
    looks_like_portal_path,
    organism_key,
    path_stem,
    percent,
    sanitize_name,
    truncated,
    utf8_text,
)


def test_years(values):
    stages = {
        "22-year-old stage": 22.0,
        "45-year-old human stage": 45.0,
        "1-year-old stage": 1.0,
        "100-year-old stage": 100.0,
        "22.5-year-old": 22.5,
        "20 year-old": None,
        "unknown": None,
        "child": None,
        "": None,
        None: None,
    }
    assert values(list(stages), "string", age_in_years(F.col("x"))) == list(stages.values())


def test_months(values):
    stages = {
        "24m": 24.0,
        "24 months": 24.0,
        "5-month-old": 5.0,
        "2.5m": 2.5,
        "stage 22 male": 22.0,
        "3 mm": 3.0,
        "adult": None,
        None: None,
    }
    assert values(list(stages), "string", age_in_months(F.col("x"))) == list(stages.values())


def test_sanitize_name(values):
    names = {
        "my dataset.h5ad": "my_dataset.h5ad",
        "dataset@special.h5ad": "dataset_special.h5ad",
        "data  with   spaces": "data_with_spaces",
        "dataset#$%^&*.h5ad": "dataset_.h5ad",
        "_leading_underscore": "leading_underscore",
        "trailing_underscore_": "trailing_underscore",
        "__multiple___underscores__": "multiple_underscores",
        "Zellen_äöü-1.h5ad": "Zellen_äöü-1.h5ad",
    }
    assert values(list(names), "string", sanitize_name(F.col("x"))) == list(names.values())


def test_paths(values):
    paths = {"/a/b/c.h5ad": "c", "c.tar.gz": "c.tar", "/a/b": "b", "/x/.hidden": ".hidden"}
    assert values(list(paths), "string", path_stem(F.col("x"))) == list(paths.values())
    assert values(["/m/ab_meta.parquet"], "string", dataset_id_from_path(F.col("x"))) == ["ab"]


def test_portal_paths(values):
    paths = {
        "10cc50a0-af80-4fa1-b668-893dd5c0113a.h5ad": True,
        "10CC50A0-AF80-4FA1-B668-893DD5C0113A.h5ad": True,
        "https://datasets.CellxGene.org/a.h5ad": True,
        "https://cziscience.com/a.h5ad": True,
        "my_dataset.h5ad": False,
    }
    assert values(list(paths), "string", looks_like_portal_path(F.col("x"))) == list(paths.values())


def test_small_helpers(values):
    assert values(["Mus-musculus X"], "string", organism_key(F.col("x"))) == ["mus_musculus_x"]
    assert values([0.0, 59.9, 3661.5, 360000.0], "double", hms(F.col("x"))) == [
        "00:00:00",
        "00:00:59",
        "01:01:01",
        "100:00:00",
    ]
    assert values(["abcdef", "ab", None], "string", truncated(F.col("x"), 3)) == ["abc...[truncated]", "ab", None]
    assert values([bytearray("ä".encode())], "binary", utf8_text(F.col("x"))) == ["ä"]
    assert values(["A ENSMUSG00000012 B", "AENS1", "ENSG"], "string", has_ensembl_token(F.col("x"))) == [
        True,
        False,
        False,
    ]
    assert values([3, 0], "bigint", percent(F.lit(1), F.col("x"))) == [33.33, 0.0]


@pytest.mark.parametrize("seed", [42, 7])
def test_hash_uniform_is_the_md5_of_seed_and_key(values, seed):
    keys = [f"donor_{i}" for i in range(50)]
    expected = [int(hashlib.md5(f"{seed}:{k}".encode()).hexdigest()[:8], 16) % 10000 / 10000 for k in keys]
    assert values(keys, "string", hash_uniform(["x"], seed)) == expected
