"""What the plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from tidemill.registry import all_queries

SMALL = "/root/testdata/sf0.001"


def plan(spark, name):
    df = all_queries()[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,node", [
    ("join_broadcast", "BroadcastHashJoin"),
    ("join_map_side", "BroadcastHashJoin"),
    ("join_shuffle_hash", "ShuffledHashJoin"),
    ("join_sort_merge", "SortMergeJoin"),
    ("join_semi", "LeftSemi"),
    ("join_anti", "LeftAnti"),
    ("top_k", "TakeOrderedAndProject"),
    ("sample_n", "TakeOrderedAndProject"),
    ("topn_per_group", "WindowGroupLimit"),
    ("win_sql_text", "WindowGroupLimit"),
])
def test_node(spark, name, node):
    assert node in plan(spark, name)


def test_cross_join_is_an_explode(spark):
    text = plan(spark, "join_cross")
    assert "Generate explode" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", [
    "word_count", "agg_sum_count", "agg_stats", "agg_fold", "agg_count", "dashboard_batch"])
def test_partial_aggregate_before_the_shuffle(spark, name):
    text = plan(spark, name)
    partial = re.search(r"partial_(count|sum|avg)", text)
    assert partial and text.index("Exchange") < partial.start()


@pytest.mark.parametrize("name,columns", [
    ("agg_global_sum", "value:double"),
    ("agg_count", "o_orderstatus:string"),
    ("word_count", "text:string"),
    ("longest_streak", "ts:timestamp_ntz,user_id:bigint"),
])
def test_scan_reads_only_its_columns(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


@pytest.mark.parametrize("name,pushed", [
    ("filter_range", "GreaterThanOrEqual(o_totalprice,50000"),
    ("join_chain", "EqualTo(o_orderstatus,F)"),
    ("filter_expr", "GreaterThan(o_totalprice"),
])
def test_filter_reaches_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


def test_partition_pruning(spark, small, tmp_path):
    path = str(tmp_path / "by_status")
    small.orders.write.partitionBy("o_orderstatus").parquet(path)
    df = spark.read.parquet(path).filter(F.col("o_orderstatus") == "F")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*o_orderstatus", text)


def test_no_single_task_window_or_python_in_headline_plans(spark):
    for name in ("longest_streak", "pv_uv", "pivot_sum", "user_level", "peaks_troughs"):
        text = plan(spark, name)
        assert "SinglePartition" not in text
        assert "Python" not in text and "Pandas" not in text
