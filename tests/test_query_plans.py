"""What the plans of the main queries must look like."""

import re

import pytest

import __spark_entry__ as contract

FOLDER = contract.SMOKE_FOLDER


@pytest.fixture
def plan(spark):
    def of(name):
        return contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()

    return of


def read_schema(plan, table):
    scan = next(line for line in plan.splitlines() if "FileScan" in line and f"{table}.parquet" in line)
    return set(re.findall(r"(\w+)#", scan.split("Batched")[0]))


def test_top_sentences_are_cut_before_the_shuffle(plan):
    found = plan("c1_cell_sentence_topn")
    assert re.search(r"WindowGroupLimit .*Partial", found)
    assert read_schema(found, "lineitem") == {"l_orderkey", "l_partkey", "l_quantity"}
    assert "BroadcastHashJoin" in found and "SortMergeJoin" not in found


def test_filters_reach_the_scan(plan):
    assert "EqualTo(o_orderstatus,F)" in plan("f4_equality_filters")
    assert "PushedFilters: [IsNotNull" in plan("f1_known_age")


def test_hash_splits_do_not_shuffle(plan):
    for name in ("sp1_cell_random_split", "sp3_donor_random_split", "sp6_cell_hash_split"):
        assert "Exchange hashpartitioning" not in plan(name)


def test_summaries_scan_the_cells_once_per_branch_of_one_reused_exchange(spark):
    result = contract.queries()["a11_dataset_summary"](spark, FOLDER)
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("orders.parquet") == 1 and "ReusedExchange" in final


def test_limits_are_taken_per_task(plan):
    for name in ("a25_top_values", "t6_head", "a14_null_age_sample"):
        assert "TakeOrderedAndProject" in plan(name)


@pytest.mark.parametrize("name", ["c2_build_dataset", "c3_convert_dataset", "c1_cell_sentence_variants"])
def test_expression_is_shuffled_once_and_without_symbols(spark, name):
    """From the scan of the line items up to the array form there is one exchange, of numbers by cell."""
    result = contract.queries()[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "cell_id" in line]
    assert exchanges and not any("symbol" in line for line in exchanges)
    by_gene = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "gene_idx" in line]
    assert not by_gene or name == "c1_cell_sentence_variants"  # there the values are summed by cell and gene first
    grouped = re.findall(r"collect_list\(struct\(indices, ([^)]*)\)", plan.lower())
    assert all("symbol" not in g for g in grouped)
