"""Physical-plan checks: the plans we want at scale, not just right rows."""

import pytest

from duetlog.catalog import registry

SF = "/root/testdata/sf0.01"
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(spark, key):
    registry.load_all()
    df = registry.run(key, spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = ["join_ip_range_bucketed", "pipe_cohort_stats", "pipe_farm_activity", "pipe_top_provinces_user_type",
        "str_alarm_status", "pipe_log_ip_counts", "pipe_city_active_new", "pipe_avg_age", "scl_ip_to_long",
        "udf_age", "udf_country_pair", "str_alarm_message", "pipe_active_union"]


@pytest.mark.parametrize("key", LAZY)
def test_no_python_in_plan(spark, key):
    p = plan(spark, key)
    assert not any(n in p for n in PY_NODES), p


def test_bucketed_interval_join_is_hash_join(spark):
    p = plan(spark, "join_ip_range")
    assert "BroadcastNestedLoopJoin" not in p and "BroadcastHashJoin" in p
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(spark, "join_ip_range_bucketed")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastNestedLoopJoin" not in p and "hashpartitioning(_bucket" in p and "_salt" in p


def test_topk_uses_group_limit(spark):
    registry.load_all()
    df = registry.run("pipe_top_provinces_user_type", spark, SF)
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "flt_in_list")
    assert "PushedFilters: [In(o_orderpriority" in p
    p = plan(spark, "agg_sum")
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in p


def test_cohort_dedups_once(spark):
    """The whole-row de-duplication is the only full shuffle and runs once:
    every other branch reads it through a reused exchange."""
    registry.load_all()
    df = registry.run("pipe_cohort_stats", spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dedup = [ln for ln in final.splitlines()
             if "Exchange hashpartitioning(" in ln and "a_birthday" in ln and "ReusedExchange" not in ln]
    assert len(dedup) == 1, dedup


def test_global_row_number_not_single_partition(spark):
    """Only the per-partition counts (one row per partition) meet in one
    task; the rows themselves stay range-partitioned."""
    lines = plan(spark, "win_global_row_number").splitlines()
    singles = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    assert singles and all("keys=[_pid" in lines[i + 1] for i in singles)


NO_CROSS = ["pipe_cohort_stats", "pipe_farm_activity", "pipe_top_provinces_user_type", "str_alarm_status",
            "pipe_city_active_new", "pipe_avg_age", "pipe_city_share", "pipe_country_spend", "agg_upper_median",
            "str_alarm_message", "snk_upsert_accumulate", "join_left_anti", "join_inner_notnull", "scl_percent",
            "join_ip_range", "join_ip_range_bucketed", "join_broadcast_dim", "win_percent_of_total", "win_rank"]


@pytest.mark.parametrize("key", NO_CROSS)
def test_no_cross_join(spark, key):
    """No query pairs every row with every row: no cartesian product and no
    nested-loop join."""
    p = plan(spark, key)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, p
