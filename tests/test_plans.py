"""Physical plans: no Python in the data path, no pairs without a key, pruned scans."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from forgelens import queries
from forgelens.operators import current
from forgelens.plans.stores import VersionedTable

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    "stg_repositories", "stg_pull_requests", "stg_issues", "fact_repo_snapshots", "fact_pull_requests", "fact_issues",
    "lineitem_latest", "latest_repos", "dim_developers", "repos_snapshot", "dim_repos", "mart_trending_repos",
    "mart_developer_activity", "mart_community_health", "repo_metrics_over_time", "pull_requests_by_owner",
    "search_repositories", "page_dedup", "dq_source",
]
FORBIDDEN = re.compile(
    "CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas|MapInArrow|FlatMapGroups|AttachDistributedSequence"
)

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_unkeyed_pairs(spark, name):
    found = FORBIDDEN.findall(plan_of(queries.queries()[name](spark, SF_DIR)))
    assert found == []


@needs_tables
def test_feeds_scan_only_what_a_query_needs(spark):
    staged = queries.REGISTERED["fact_issues"](spark, SF_DIR).select("issue_id", "hours_to_close")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(staged))
    assert schemas == ["event_id:bigint,ts:timestamp_ntz,event_type:string"]


def test_stored_history_is_filtered_and_pruned_in_the_scan(spark, tmp_path):
    rows = spark.range(10).select(
        F.col("id").alias("repo_id"), F.when(F.col("id") % 2 == 0, F.current_timestamp()).alias("dbt_valid_to"),
        F.lit("wide").alias("description"),
    )
    stored = VersionedTable(spark, str(tmp_path / "h")).replace(rows, "1")
    plan = plan_of(current(stored).select("repo_id"))
    assert "PushedFilters: [IsNull(dbt_valid_to)]" in plan
    assert "ReadSchema: struct<repo_id:bigint,dbt_valid_to:timestamp>" in plan


@needs_tables
def test_hot_owner_is_aggregated_before_it_moves(spark):
    plan = plan_of(queries.REGISTERED["mart_developer_activity"](spark, SF_DIR))
    partial, exchange = plan.rindex("partial_count"), plan.index("Exchange hashpartitioning(owner_login")
    assert exchange < partial
