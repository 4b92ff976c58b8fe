"""Queries beside their SQL on tables where one key holds a third of the rows."""

import duckdb
import pytest

import __spark_entry__ as contract
from workload.check import TABLES, connect, differences

SKEW = {
    "orders": "* REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey)",
    "lineitem": """* REPLACE (
        CASE WHEN hash(l_linenumber, l_suppkey, l_shipdate) % 3 = 0 THEN 0 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN hash(l_extendedprice) % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey)""",
    "part": "* REPLACE (CASE WHEN hash(p_partkey) % 3 = 0 THEN 'Brand#1' ELSE p_brand END AS p_brand)",
    "events": "* REPLACE (CASE WHEN hash(event_id) % 3 = 0 THEN 'view' ELSE event_type END AS event_type)",
}
NAMES = [
    "c1_cell_sentence_topn",
    "c1_cell_sentence_variants",
    "c1_cell_sentence_sparse",
    "c1_cell_sentence_zero_filled",
    "c2_build_dataset",
    "c6_species_summary",
    "sp4_donor_split_by_age",
    "sp5_donor_quota_split",
    "sp5_donor_quota_split_cells",
    "j4_donor_split_join",
    "j7_expression_with_symbols",
    "a7_donor_median_age",
    "a22_last_value_per_message",
    "u3_keep_first_order",
    "t2_top_genes",
    "st1_incremental_ingest",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for table in TABLES:
        columns = SKEW.get(table, "*")
        source = f"read_parquet('{contract.SMOKE_FOLDER}/{table}.parquet')"
        duckdb.sql(f"COPY (SELECT {columns} FROM {source}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return folder, connect(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_on_skewed_tables(spark, skewed, name):
    folder, duck = skewed
    result = contract.queries()[name](spark, folder)
    assert differences(result, duck, contract.oracle_sql()[name]) == []
