"""Window functions across slabs against Spark's own, on tables cut into very small slabs."""

import random

import pytest
from conftest import executed_plan
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabloom.operators import across as a


def some_rows(seed, n=400, hot=0.6):
    """Keys of which one has most rows, orders with long ties, values with nulls."""
    chance = random.Random(seed)
    key = lambda: "hot" if chance.random() < hot else chance.choice(["a", "b", "z", None])
    order = lambda: chance.choice([None, 1, 1, 1, 2, 3, 5, 8, chance.randint(0, 50)])
    value = lambda: chance.choice([None, chance.randint(-9, 9)])
    return [(i, key(), order(), value()) for i in range(n)]


SCHEMA = "id int, k string, o int, v int"


def compared(spark, rows, functions, native, keys, order, descending=(), slab_rows=7):
    """Rows of the functions across slabs and of Spark's window functions."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = a.across(df, order, functions, keys, descending, slab_rows=slab_rows)
    assert got.columns == [*df.columns, *functions]
    w = Window.partitionBy(*keys).orderBy(*(F.desc(c) if c in descending else F.asc(c) for c in order))
    wanted = df.select(*df.columns, *(f(w).alias(n) for n, f in native.items()))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, wanted.collect())))


def upto(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def tied():
    return {"r": (a.rank(), lambda w: F.rank().over(w)), "d": (a.dense_rank(), lambda w: F.dense_rank().over(w))}


def unique():
    return {
        "n": (a.row_number(), lambda w: F.row_number().over(w)),
        "n3": (a.ntile(3), lambda w: F.ntile(3).over(w)),
        "n100": (a.ntile(100), lambda w: F.ntile(100).over(w)),
        "lag1": (a.lag("v"), lambda w: F.lag("v").over(w)),
        "lag5": (a.lag("v", 5, 77), lambda w: F.lag("v", 5, 77).over(w)),
        "lead2": (a.lead("v", 2), lambda w: F.lead("v", 2).over(w)),
        "back": (a.lag("v", -2), lambda w: F.lead("v", 2).over(w)),
        "first": (a.first_value("v"), lambda w: F.first("v").over(w)),
        "first_known": (a.first_value("v", True), lambda w: F.first("v", True).over(upto(w))),
        "latest": (a.latest_value("v"), lambda w: F.last("v", True).over(upto(w))),
        "closing": (a.closing_value("v"), lambda w: F.last("v").over(whole(w))),
        "closing_known": (a.closing_value("v", True), lambda w: F.last("v", True).over(whole(w))),
        "sum": (a.running_sum("v"), lambda w: F.sum("v").over(upto(w))),
        "count": (a.running_count("v"), lambda w: F.count("v").over(upto(w))),
        "min": (a.running_min("v"), lambda w: F.min("v").over(upto(w))),
        "max": (a.running_max(F.col("v") * 2), lambda w: F.max(F.col("v") * 2).over(upto(w))),
        "week": (a.sliding(F.sum("v"), 6), lambda w: F.sum("v").over(w.rowsBetween(-6, 0))),
        "around": (a.sliding(F.max("v"), 3, 4), lambda w: F.max("v").over(w.rowsBetween(-3, 4))),
    }


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("descending", [[], ["o"]])
def test_ties_that_run_through_slabs(spark, keys, descending):
    functions, native = ({n: x[i] for n, x in tied().items()} for i in (0, 1))
    compared(spark, some_rows(1 + len(keys)), functions, native, keys, ["o"], descending, slab_rows=3 + 2 * len(descending))


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("descending", [[], ["o"]])
def test_every_function(spark, keys, descending):
    functions, native = ({n: x[i] for n, x in (tied() | unique()).items()} for i in (0, 1))
    compared(spark, some_rows(3), functions, native, keys, ["o", "id"], descending)


def test_one_tie_and_one_key(spark):
    rows = [(i, "hot", 1, i % 3) for i in range(100)]
    functions, native = ({n: x[i] for n, x in tied().items()} for i in (0, 1))
    compared(spark, rows, functions, native, ["k"], ["o"], slab_rows=3)


def test_a_key_for_each_row(spark):
    rows = [(i, str(i), 1, i % 3) for i in range(60)]
    functions, native = ({n: x[i] for n, x in (tied() | unique()).items()} for i in (0, 1))
    compared(spark, rows, functions, native, ["k"], ["o", "id"], slab_rows=4)


def test_reach_over_the_size_of_a_slab(spark):
    """A slab has as many rows as the farthest function reaches."""
    native = {"x": lambda w: F.lag("v", 40).over(w), "y": lambda w: F.sum("v").over(w.rowsBetween(-30, 25))}
    compared(spark, some_rows(5), {"x": a.lag("v", 40), "y": a.sliding(F.sum("v"), 30, 25)}, native, ["k"], ["o", "id"], slab_rows=2)


def test_empty_and_refused(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert a.across(df, ["o"], {"r": a.rank(), "l": a.lag("v")}, ["k"]).count() == 0
    with pytest.raises(ValueError, match="taken"):
        a.across(df, ["o"], {"v": a.rank()})
    with pytest.raises(ValueError):
        a.ntile(0)
    with pytest.raises(ValueError):
        a.sliding(F.sum("v"), -1)


def test_no_task_gets_the_hot_key(spark):
    """The only window over a whole group is that of a slab: its key is in the partitioning."""
    df = spark.range(20_000).selectExpr("id", "'hot' as k", "id % 7 as o", "id % 100 as v")
    got = a.across(df, ["o", "id"], {"s": a.running_sum("v"), "l": a.lag("v", 3)}, ["k"], slab_rows=500)
    plan = executed_plan(got)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert got.where("id = 19999").select("s").first().s is not None
    widest = a.across(df, ["o", "id"], {"l": a.lag("v", 3)}, ["k"], slab_rows=500)
    shuffled = executed_plan(widest)
    assert "hashpartitioning(_across_slab" in shuffled and "SinglePartition" not in shuffled.split("Window")[0]


def test_tasks_follow_the_rows_and_not_the_session(spark, settings, tmp_path):
    """Ranges and slabs are tasks of their own, however few partitions the session's shuffles have."""
    df = spark.range(2_000).selectExpr("id", "if(id % 3 = 0, 'a', 'hot') as k", "id % 7 as o", "id % 100 as v")
    with settings(spark__sql__shuffle__partitions="1"):
        got = a.across(df, ["o", "id"], {"s": a.running_sum("v")}, ["k"], slab_rows=100, under=str(tmp_path))
        assert got.count() == 2_000
    for purpose in ("numbered-[0-9a-f]*", "across-slabs-*"):
        assert len(list(tmp_path.glob(f"{purpose}/part-*"))) > 5
