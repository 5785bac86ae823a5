"""Plan-shape checks: the properties the scale design relies on, read from
the physical plans of the registered queries."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from lodestar.plans import catalog

QUERIES = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}

# queries whose plan is built before any fit (cheap to plan on every run)
PLANNED = [n for n in QUERIES if not n.startswith(("als_", "classification_", "logreg_",
                                                   "kmeans_", "model_", "cluster_"))]


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["topn_per_cluster", "user_top_rated", "leave_n_out"])
def test_top_n_is_limited_before_the_shuffle(spark, name):
    plan = _plan(spark, name)
    partial = plan.find("WindowGroupLimit")
    assert "Partial" in plan and "Final" in plan
    # the partial limit sits below (after, in the text) the exchange it feeds
    assert plan.find("Exchange hashpartitioning", partial) > partial


def test_centres_are_broadcast_after_the_size_check(spark):
    plan = _plan(spark, "topn_per_cluster")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_point_lookup_filters_reach_the_scans(spark):
    plan = _plan(spark, "filter_pair")
    assert re.search(r"DataFilters: \[[^\]]*\(l_partkey#\d+L = \d+\)", plan)
    assert re.search(r"DataFilters: \[[^\]]*\(o_custkey#\d+L = \d+\)", plan)


def test_size_check_measures_only_small_tables_and_bounds_bytes(spark):
    from lodestar.operators import lookup
    from pyspark.sql import functions as F
    df = spark.range(1_000_000).withColumn("v", F.raise_error(F.lit("must not run")).cast("string"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("size-check", "")
    lookup.checked_broadcast(df, 1 << 20)  # its estimate alone is beyond the bound
    assert tracker.getJobIdsForGroup("size-check") == []
    spark.sparkContext.setJobGroup("", "")
    facts = spark.range(5).withColumnRenamed("id", "k")
    dictionary = spark.range(1000)
    for bound, join in ((1 << 20, "BroadcastHashJoin"), (10, "SortMergeJoin")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = facts.join(lookup.checked_broadcast(dictionary, bound), F.col("k") == F.col("id"))
        text = plan._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert join in text and "SinglePartition" not in text


def test_capped_leave_n_out_sends_no_rows_to_one_task(spark):
    plan = _plan(spark, "leave_n_out_capped")
    assert "SinglePartition" not in plan and "Limit " not in plan.replace("GroupLimit", "")


def test_top_n_is_salted_before_its_last_window(spark):
    plan = _plan(spark, "topn_per_cluster")
    assert plan.count("WindowGroupLimit") >= 4 and "pmod(xxhash64" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "user_history")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("l_comment" not in s and "l_shipdate" not in s for s in schemas)
    assert any(s == "struct<l_orderkey:bigint,l_partkey:bigint>" or "l_quantity" in s for s in schemas)


@pytest.mark.parametrize("name", PLANNED)
def test_no_all_pairs_product(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_union_blocks_read_pruned_fold_directories(spark):
    plan = _plan(spark, "union_splits")
    assert plan.count("PartitionFilters: [isnotnull(fold") == 4


def test_one_user_recommendation_has_no_all_pairs_product(spark):
    plan = _plan(spark, "recommend_topk")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "TakeOrderedAndProject" in plan


def test_lloyd_assignment_is_a_narrow_projection(spark):
    plan = _plan(spark, "kmeans_lloyd_assign")
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("name", ["kmeans_lloyd_centroids", "cluster_assignments",
                                  "classification_tree_default", "als_factor_shape"])
def test_fitted_queries_have_no_all_pairs_product(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
