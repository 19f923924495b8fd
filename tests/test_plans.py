"""Plan properties the design relies on (checked on the executed plan)."""

import re

import pytest

import __spark_entry__ as entry
from assetlens import operators as op

from sf_dirs import SF001


def executed(df) -> str:
    """The executed (adaptive) plan as text, subquery plans included."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def main_scans(df, table: str) -> list[str]:
    """Scans of ``table`` among the leaves of the planner's physical plan (scalar subqueries are
    expressions there, not children, so only the query's own scans are listed)."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    names = [leaves.apply(i).toString() for i in range(leaves.size())]
    return [n for n in names if f"{table}.parquet" in n]


@pytest.mark.parametrize("name", ["profile_src", "flow_touch_pairs", "flow_touch_semi", "profile_multiset_csv",
                                  "flow_src_asset"])
def test_single_pass_over_flows_no_theta_joins(spark, name):
    df = entry.queries()[name](spark, SF001)
    plan = executed(df)
    scans = main_scans(df, "events")
    assert len(scans) == 1, scans
    # only the columns the adapter needs are read
    read = re.search(r"ReadSchema: struct<([^>]*)>", scans[0]).group(1)
    assert {c.split(":")[0] for c in read.split(",")} <= {"event_id", "ts", "user_id", "event_type"}
    for bad in ("NestedLoopJoin", "CartesianProduct"):
        assert bad not in plan


def test_flows_not_shuffled_when_asset_side_is_small(spark):
    plan = executed(entry.queries()["flow_src_asset"](spark, SF001))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_latest_is_an_aggregate_not_a_window(spark):
    df = op.latest_params(op.normalise_params(__import__("assetlens.sources.fixtures", fromlist=["x"])
                                              .model_params(spark)))
    plan = executed(df)
    assert "Window" not in plan and "max_by" in plan.lower()


def test_profile_meets_a_small_scope_before_any_shuffle_of_flows(spark):
    lines = executed(entry.queries()["profile_src"](spark, SF001)).splitlines()
    join_at = next(i for i, l in enumerate(lines) if "BroadcastHashJoin" in l and "_eid" in l)
    # below (after, in the text) the join the flow side has no hash exchange; above it edges are combined map-side
    flow_side = [l for l in lines[join_at:] if "hashpartitioning(src_id" in l or "seg_hour" in l]
    assert not flow_side
    # Catalyst drops the distinct below collect_set, so one combine and one shuffle are left
    assert any("partial_" in l for l in lines[:join_at])


def test_profile_preaggregates_before_a_shuffled_join(spark):
    from assetlens.plans.queries import Inputs
    inp = Inputs(spark, SF001)
    small = op.profile_edges(inp.complete, inp.scoped("contains"))
    large = op.profile_edges(inp.complete, inp.scoped("contains"), max_rows=0)
    lines = executed(large).splitlines()
    assert any("HashAggregate" in l and "seg_hour" in l for l in lines)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
