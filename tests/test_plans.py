"""Plan guards: properties of the physical plans that must hold at any
scale, checked on every catalog query."""

import pytest

from daybook.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# These run whole pipelines or streams when called; their returned frames
# are plain scans of the stored result.
HEAVY = {"daily_runs_row_counts", "backfill_row_counts", "stream_scd2_available_now",
         "backfill_dim_products", "backfill_dim_comments", "backfill_fact_comments",
         "daily_dim_products", "daily_dim_comments", "daily_fact_comments", "daily_test_report",
         "stream_scd2_comments", "stream_type_drift"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "LocalCheckpoint"]


def plan_of(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - HEAVY))
def test_no_nested_loops_udfs_or_cartesian(spark, name):
    plan = plan_of(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_topk_limits_before_the_shuffle(spark):
    plan = plan_of(spark, "topk_comments_per_product")
    lines = plan.split("\n")
    partial = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l]
    exchange = [i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l]
    # Printed top-down: the partial limit is below (feeds) the shuffle.
    assert partial and exchange and partial[0] > exchange[0]


def test_gates_are_scalar_subqueries(spark):
    plan = plan_of(spark, "incremental_gate")
    assert "Subquery" in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(spark, "asof_dim_join")
    for unused in ("l_extendedprice", "l_tax", "l_suppkey", "l_linestatus", "p_brand", "p_size"):
        assert unused not in plan, unused


def test_dedupe_and_distinct_combine_before_the_shuffle(spark):
    """A key holding a large share of the rows is reduced per task first."""
    plan = plan_of(spark, "clean_products")
    lines = plan.split("\n")
    partial = [i for i, l in enumerate(lines) if "partial_max(struct(" in l]
    exchange = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(id" in l]
    assert partial and exchange and partial[0] > exchange[0]
