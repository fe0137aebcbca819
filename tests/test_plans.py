"""Physical plans: no cross joins, no Python, pruned scans, combining before the shuffle."""

import re

import __spark_entry__ as driver
import pytest

QUERIES = driver.QUERIES
BATCH = sorted(n for n in QUERIES if not n.endswith("stream"))


def plan_of(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|MapInArrow|ExistingRDD", plan)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("daily_kpi", "struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>"),
        ("on_time_rate", "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"),
        ("dq_pk_duplicates", "struct<l_orderkey:bigint,l_linenumber:int>"),
        ("retention_24h", "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>"),
    ],
)
def test_scans_read_only_what_is_needed(spark, sf_dir, name, columns):
    plan = plan_of(spark, sf_dir, name)
    assert re.findall("ReadSchema: (.*)", plan) == [columns]


def test_filters_reach_the_scan(spark, sf_dir):
    assert "PushedFilters: [Or(IsNull(ts),GreaterThanOrEqual(ts," in plan_of(spark, sf_dir, "retention_24h")
    assert "PartitionFilters: [isnotnull(order_month" in plan_of(spark, sf_dir, "partition_scan")


@pytest.mark.parametrize("name", ["daily_kpi", "latest_per_courier", "order_perf_fold", "order_lifecycle"])
def test_groups_are_combined_before_the_shuffle(spark, sf_dir, name):
    assert "partial_" in plan_of(spark, sf_dir, name)


def test_a_fold_of_many_rounds_shuffles_each_round_once(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "order_perf_upsert")
    assert plan.count("Exchange hashpartitioning") == 5


def test_rounds_of_reference_batching_do_not_share_a_stage(spark, sf_dir):
    """The last round and the stored state are shuffled; earlier rounds are not sorted again in the same task."""
    plan = plan_of(spark, sf_dir, "order_perf_reference_batching")
    assert plan.count("Exchange hashpartitioning") == 2
    assert len(re.findall(r"\bSort \[order_id", plan)) <= 4


def test_lookup_above_the_threshold_is_not_broadcast(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, sf_dir, "fact_key_lookup")
        assert "SortMergeJoin" in plan
        assert len(re.findall("BroadcastHashJoin", plan)) == 1  # the literal status table
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
