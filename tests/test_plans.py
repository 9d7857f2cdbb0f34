"""Shape of the physical plans."""

from __future__ import annotations

import re

import pytest

from checks.queries import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "MapInPandas", "FlatMapGroups")


def plan_of(spark, sf_dir, key):
    return QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith(("stream_", "live_"))))
def test_no_cross_join_and_no_python(spark, sf_dir, key):
    plan = plan_of(spark, sf_dir, key)
    assert not [word for word in FORBIDDEN if word in plan]


@pytest.mark.parametrize(
    ("key", "exchanges"),
    [
        ("activity_totals", 1), ("activity_counts", 1), ("latest_per_key", 1), ("wellbeing_days", 1),
        ("null_profile", 1), ("describe_stats", 1), ("eco_budget", 1), ("cdc_parse", 0),
        ("cdc_rejects", 0), ("commute_validate", 0), ("commute_errors", 0), ("distance_by_city", 0),
        ("eco_bonus", 0), ("eco_filter", 0), ("export_stats_latest", 3), ("active_employees", 2),
    ],
)
def test_number_of_shuffles(spark, sf_dir, key, exchanges):
    plan = plan_of(spark, sf_dir, key)
    assert len(re.findall(r"[-+] Exchange", plan)) == exchanges


@pytest.mark.parametrize(
    ("key", "columns"),
    [
        ("export_stats", {"c_acctbal", "c_mktsegment"}),
        ("activity_counts", {"o_custkey"}),
        ("wellbeing_days", {"user_id", "ts"}),
        ("eco_budget", {"c_acctbal", "c_mktsegment"}),
        ("latest_per_key", {"o_custkey", "o_totalprice", "o_orderdate", "o_orderkey", "o_orderpriority"}),
    ],
)
def test_only_needed_columns_are_read(spark, sf_dir, key, columns):
    scans = re.findall(r"FileScan parquet \[(.*?)\]", plan_of(spark, sf_dir, key))
    assert len(scans) == 1
    assert {part.split("#")[0] for part in scans[0].split(",")} == columns


def test_lookup_is_pushed_down(spark, sf_dir):
    assert "EqualTo(o_custkey,76)" in plan_of(spark, sf_dir, "point_lookup")


def test_top_rows_need_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(spark, sf_dir, "top_active")
