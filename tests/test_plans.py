"""Plan shape of the catalog: pushdown, pruning, strategies, no Python in the hot path."""

import re

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from brindle.plans import catalog
from brindle.plans.studies import physical_plan

FOLDER = "/root/testdata/sf0.001"
LAZY = [n for n in catalog.QUERIES if not n.startswith(("stream_", "als_", "trending_now", "tuning_"))]


def plan(spark, name):
    return physical_plan(catalog.QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(spark, name)
    for word in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert word not in text
    # Quantiles look a handful of ranks up by range; MLlib scores blocks of factors pairwise.
    if "BroadcastNestedLoopJoin" in text:
        assert name.startswith(("factor_top_k", "price_quantiles", "latency_quantiles"))


def test_filter_reaches_the_scan(spark):
    text = plan(spark, "winter_filter")
    assert "GreaterThanOrEqual(l_quantity,40.0)" in text and "GreaterThan(l_extendedprice,50000.0)" in text
    assert "Exchange" not in text


def test_columns_are_pruned(spark):
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan(spark, "largest_total_part")).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_suppkey", "l_quantity", "l_linenumber"}


def test_strategies(spark):
    assert "BroadcastHashJoin" in plan(spark, "broadcast_join_average")
    assert "SortMergeJoin" in plan(spark, "merge_join_average")
    assert "TakeOrderedAndProject" in plan(spark, "top_routes")
    assert re.search(r"PartitionFilters: \[.*YEAR", plan(spark, "partition_pruning"))
    assert "WindowGroupLimit" in plan(spark, "top_per_supplier")


@pytest.mark.parametrize("name,exchanges", [
    ("carrier_summary", 1), ("carrier_flag_month_average", 1), ("moving_average", 2), ("running_total", 2),
    ("largest_total_part", 1), ("spread_sample", 1), ("latest_order", 1)])
def test_number_of_shuffles(spark, name, exchanges):
    assert len(re.findall(r"^\(\d+\) Exchange", plan(spark, name), re.M)) == exchanges
