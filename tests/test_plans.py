"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

import re

import pytest

from tallybook.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, column", [("fy_ohlcv_range_end_exclusive", "l_shipdate")])
def test_date_range_reaches_the_scan(spark, name, column):
    pushed = re.search(r"PushedFilters: \[([^]]*)", plan(spark, name)).group(1)
    assert f"GreaterThanOrEqual({column}" in pushed


@pytest.mark.parametrize("name, columns", [
    ("yoy_growth_label_order", {"l_suppkey", "l_extendedprice", "l_shipdate"}),
    ("asof_forward", {"o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"}),
    ("html_list_items", {"page_id", "html"}),
])
def test_only_needed_columns_are_read(spark, name, columns):
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan(spark, name)).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == columns


@pytest.mark.parametrize("name, shuffles", [
    ("cdc_latest_composite_key", 1), ("cdc_resolve_by_time", 1), ("cdc_resolve_sticky", 1), ("fy_ohlcv", 2),
    ("kpi_ratios", 1), ("html_list_items", 0), ("exclude_prefix", 0),
    # Line items by month; both sides of the merge by key; the joined rows by company; the final sort.
    ("statement_kpis", 5),
    # Daily bars, then by company and year, then the few rows left by company.
    ("asof_forward", 3),
])
def test_number_of_shuffles(spark, name, shuffles):
    assert len(re.findall(r"Exchange (?:hash|range)partitioning", plan(spark, name))) == shuffles


@pytest.mark.parametrize("name", ["cdc_resolve_sticky", "kpi_ratios", "fy_ohlcv", "asof_forward", "cdc_deleted_keys"])
def test_groups_are_combined_before_the_shuffle(spark, name):
    text = plan(spark, name)
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "partial_" in below or "Aggregate(keys=" in below


@pytest.mark.parametrize("name", ["fy_ohlcv", "fy_ohlcv_range_end_exclusive", "fy_ohlcv_by_name", "asof_forward",
                                  "asof_forward_within_90_days"])
def test_bars_are_aggregated_by_hash(spark, name):
    assert "SortAggregate" not in plan(spark, name)


@pytest.mark.parametrize("name, scans", [("summary_average_row", {"orders": 1, "customer": 1}),
                                         ("statement_summary", {"events": 1, "lineitem": 1}),
                                         ("upsert_snapshot", {"customer": 2, "supplier": 1})])
def test_tables_are_read_once(spark, name, scans):
    found = re.findall(r"Location: InMemoryFileIndex[^\n]*?/(\w+)\.parquet", plan(spark, name))
    assert {t: found.count(t) for t in set(found)} == scans


def test_no_python_in_any_plan(spark):
    for name in ("statement_kpis", "html_statement_load", "transpose_statement", "fy_ohlcv", "asof_forward"):
        assert "Python" not in plan(spark, name) and "CartesianProduct" not in plan(spark, name)
