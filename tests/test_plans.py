"""The physical plans that the engine counts on."""

import pytest
from pyspark.sql import functions as F

from tidelog import plans


def plan(spark, sf_dir, name):
    return plans.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["topic_scan", "read_from_offsets", "read_from_timestamp", "partition_select", "key_filter", "contract_validate",
                                  "header_get_str", "trace_extract", "decode_topic", "attest_audit", "topic_tvf", "sql_project_filter", "reject_oversize"])
def test_no_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(spark, sf_dir, name)


@pytest.mark.parametrize("name,filters", [("partition_select", "partition"), ("key_filter", "partition"), ("topic_tvf", "topic"), ("inspect_messages", "partition")])
def test_folders_are_pruned(spark, sf_dir, name, filters):
    text = plan(spark, sf_dir, name)
    start = text.index("PartitionFilters: [") + len("PartitionFilters: [")
    assert filters in text[start:start + 60]


@pytest.mark.parametrize("name", ["poll_limit", "latest_messages", "inspect_messages", "branch_messages", "semantic_search", "search_filtered", "sql_sort_limit"])
def test_top_k_is_kept_per_task(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "TakeOrderedAndProject" in text and "Window" not in text and "rangepartitioning" not in text


def test_recall_limits_before_the_shuffle(spark, sf_dir):
    text = plan(spark, sf_dir, "memory_recall")
    assert text.count("Partial") >= 2 and "WindowGroupLimit" in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("name", ["failure_streaks", "commit_offsets", "client_metrics", "metrics_history", "list_topics", "describe_topic"])
def test_aggregates_do_not_sort(spark, sf_dir, name):
    assert "SortAggregate" not in plan(spark, sf_dir, name)


def test_lineage_is_the_broadcast_side(spark, sf_dir):
    text = plan(spark, sf_dir, "branch_read")
    broadcast = text[text.index("BroadcastExchange"):]
    assert "lineage" in broadcast[:1500] or "upto" in broadcast[:1500]
    assert "SortMergeJoin" not in text


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_no_nested_loops(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
