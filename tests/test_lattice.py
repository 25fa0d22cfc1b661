"""Grouping sets by a lattice against Spark's own, and sketches against exact counts."""

import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators import lattice as la
from tabloom.operators import sketches as sk
from tabloom.sinks import publish_orc, read_published


def some_rows(spark, n=300):
    chance = random.Random(1)
    pick = lambda *values: chance.choice(values)
    rows = [(pick("x", "y", None), pick(1, 2, 3, None), pick("p", "q"), pick(True, None), chance.randint(0, 9) or None) for _ in range(n)]
    return spark.createDataFrame(rows, "a string, b int, c string, d boolean, v int").repartition(4)


def aggregates():
    return {"n": la.rows(), "k": la.known("v"), "s": la.added("v"), "lo": la.lowest("v"), "hi": la.highest("v")}


def native(df, by_sets):
    """The same by Spark's GROUPING SETS."""
    df.createOrReplaceTempView("lattice_input")
    sets = ", ".join(f"({', '.join(s)})" for s in by_sets)
    return df.sparkSession.sql(
        f"""select a, b, c, d, count(*) n, count(v) k, sum(v) s, min(v) lo, max(v) hi, grouping_id(a, b, c, d) g
            from lattice_input group by grouping sets ({sets})"""
    )


def same(got, wanted):
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, wanted.collect())))


DIMENSIONS = ["a", "b", "c", "d"]


@pytest.mark.parametrize(
    "sets",
    [la.cube(DIMENSIONS), la.rollup(DIMENSIONS), [("a", "b"), ("c",), ("d", "c", "a"), ("b",)], [("a",), ("d",)]],
    ids=["cube", "rollup", "some", "apart"],
)
def test_sets(spark, sets):
    df = some_rows(spark)
    # grouping_id needs all dimensions named in Spark's statement, so those of the finest set come along and go again
    full = [tuple(DIMENSIONS), *map(tuple, sets)] if tuple(DIMENSIONS) not in map(tuple, sets) else sets
    wanted = native(df, full)
    if len(full) != len(list(sets)):
        wanted = wanted.where("g <> 0")
    same(la.grouping_sets(df, DIMENSIONS, sets, aggregates(), "g"), wanted)


def test_an_empty_table_and_refusals(spark):
    df = some_rows(spark).where("false")
    got = la.grouping_sets(df, DIMENSIONS, la.cube(DIMENSIONS), aggregates()).collect()
    assert [tuple(r) for r in got] == [(None, None, None, None, 0, 0, None, None, None, 15)]
    with pytest.raises(ValueError, match="no dimensions"):
        la.grouping_sets(df, ["a"], [("b",)], aggregates())
    with pytest.raises(ValueError, match="taken"):
        la.grouping_sets(df, ["a"], [("a",)], {"a": la.rows()})


def test_sets_read_smaller_ones(spark):
    """No set but the finest reads the table."""
    df = some_rows(spark)
    plan = la.grouping_sets(df, DIMENSIONS, la.cube(DIMENSIONS), aggregates())._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "LogicalRDD" not in plan and plan.count("grouping-level") >= 4


def test_sketches_of_days_make_those_of_any_days(spark, tmp_path):
    path = f"file://{tmp_path}/sketches"
    days = spark.range(60_000).selectExpr("'d' || (id % 6) day", "id % 7919 as user", "cast(id % 100 as double) score")
    for day in range(6):  # each day is written when it is there
        own = sk.distinct_sketches(days.where(f"day = 'd{day}'"), ["day"], ["user", "score"])
        publish_orc(own.select("user", "score", "day"), path, ["user;string", "score;string", "day;string"], ["day"])
    stored = read_published(spark, path)
    for some in (["d0"], ["d1", "d4"], [f"d{k}" for k in range(6)]):
        exact = days.where(F.col("day").isin(some)).agg(F.count_distinct("user"), F.count_distinct("score")).first()
        found = sk.merged(stored.where(F.col("day").isin(some)), [], ["user", "score"])
        for wanted, got in zip(exact, found.select(sk.estimate("user"), sk.estimate("score")).first(), strict=True):
            assert abs(got - wanted) <= 4 * sk.relative_error() * wanted + 1
    none = sk.merged(stored.where("false"), [], ["user"]).select(sk.estimate("user")).first()[0]
    assert none == 0
