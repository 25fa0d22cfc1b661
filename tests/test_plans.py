"""What no registered query's plan may hold, since it would not survive large tables."""

import pytest

from tabloom.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert node not in plan
    # one task gathers a single row of partial results (an aggregate without keys), or nothing
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "partial_max" in part.splitlines()[1]


@pytest.mark.parametrize("name, columns", [("flagship", 3), ("agg_group", 7), ("stage_chain", 3), ("lookup_latest", 2)])
def test_scans_read_only_what_is_needed(spark, name, columns):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    assert schemas and max(s.count(":") for s in schemas) <= columns


def test_daily_windows_see_no_events(spark):
    """Below each window there is an aggregate that leaves one row per type and day."""
    for name in ("win_rank", "win_analytic", "win_frame_rows", "win_frame_range"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Window") < plan.index("HashAggregate")


def test_top_rows_per_key_are_cut_before_the_shuffle(spark):
    plan = QUERIES["win_topk_per_key"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
