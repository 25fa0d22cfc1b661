"""Workspaces: what is stored in one goes with it."""

import os

import pytest

from tabloom.durable import new_folder, shared_folder, workspace, written
from tabloom.operators import across as a
from tabloom.operators import intervals as i
from tabloom.operators import lattice
from tabloom.operators.sizing import at_once


def left_over(spark):
    folder = shared_folder(spark)
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_operators_leave_nothing_behind(spark):
    rows = spark.range(100).selectExpr("id", "id % 7 as k", "id % 10 as x")
    before = left_over(spark)
    with workspace(spark) as folder:
        assert a.across(rows, ["x", "id"], {"r": a.rank(), "l": a.lag("k")}, ["k"], slab_rows=9).count() == 100
        spans = rows.selectExpr("id as a", "x as lo", "x + 1 as hi")
        assert i.range_aggregate(spans, rows, "lo", "hi", "x", {"n": i.matches(), "m": i.least("id")}).count() == 100
        assert i.range_join(spans, rows, "lo", "hi", "x").count() > 100
        assert lattice.grouping_sets(rows, ["k", "x"], lattice.cube(["k", "x"]), {"n": lattice.rows()}).count() > 10
        assert os.listdir(folder)
    assert left_over(spark) == before


def test_nested_workspaces_and_errors(spark):
    before = left_over(spark)
    with workspace(spark) as outer:
        kept = written(spark.range(3), "kept")
        with pytest.raises(RuntimeError), workspace(spark) as inner:
            assert inner.startswith(outer)
            written(spark.range(3), "gone")
            raise RuntimeError
        assert not os.path.exists(inner) and kept.count() == 3
        assert new_folder(spark, "x").startswith(f"{outer}/")
    assert left_over(spark) == before
    assert not new_folder(spark, "x").startswith(outer)


def test_jobs_run_at_once_share_the_workspace(spark):
    with workspace(spark) as folder:
        paths = at_once(lambda n: new_folder(spark, str(n)), 4)
    assert all(p.startswith(f"{folder}/") for p in paths)
