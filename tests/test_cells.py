import math
import random
import struct
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan_of, values
from tabloom.operators import cells_to_wide, wide_to_cells
from tabloom.sinks import write_cells


@pytest.fixture
def cells(spark):
    rows = [
        ("r1", "d", "a", "1", 1),
        ("r1", "d", "a", "2", 2),
        ("r1", "e", "a", "other family", 1),
        ("r2", "d", "b:c", "colon", 1),
        ("r3", "d", "undeclared", "x", 1),
    ]
    df = spark.createDataFrame(rows, "rowkey string, family string, qualifier string, value string, ts int")
    return df.withColumn("value", F.col("value").cast("binary"))


def test_cells_to_wide(cells):
    out = cells_to_wide(cells, ["d:a", "e:a", "d:b:c", "d:none"], version="ts").orderBy("rowkey")
    assert out.columns == ["rowkey", "d:a", "e:a", "d:b:c", "d:none"]
    assert values(out) == [
        ("r1", "2", "other family", None, None),
        ("r2", None, None, "colon", None),
        ("r3", None, None, None, None),
    ]


def test_declared_cells_only(cells):
    out = cells_to_wide(cells, ["d:a", "d:b:c"], version="ts", keep_empty=False).orderBy("rowkey")
    assert values(out) == [("r1", "2", None), ("r2", None, "colon")]


def test_what_is_sorted_holds_no_undeclared_value(cells):
    """Below the aggregate that sorts: row key, the column's number, and a cell only where there is one."""
    wide = cells_to_wide(cells, ["d:a", "d:b"], version="ts")
    plan = wide._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Aggregate") == 2  # partial and final
    below = plan.split("SortAggregate")[2].split("Project [")[1]
    assert "CASE WHEN isnotnull(place" in below and "concat_ws" not in plan
    physical = plan_of(wide).split("== Physical Plan ==")[1]
    assert physical.count("Exchange") == 1 and "partial_max" in physical


def encoded(df, schema, row):
    out = {}
    for r in wide_to_cells(df, schema, row=row, family="d").collect():
        out.setdefault(bytes(r.rowkey), {})[r.qualifier] = bytes(r.value)
        assert r.family == "d"
    return out


def test_encoding_is_big_endian(spark):
    numbers = [0, 1, -1, 258, -2, 2**31 - 1, -(2**31)]
    floats = [0.0, -0.0, 1.5, -1.5, 3.4e38, 1e-40, float("inf"), 0.1]
    rows = [
        (f"k{i}", n, n * 2**31, f, f, i % 2 == 0, {"a": n})
        for i, (n, f) in enumerate((n, f) for n in numbers for f in floats)
    ]
    df = spark.createDataFrame(rows, "k string, i int, l long, f float, d double, b boolean, s struct<a: int>")
    schema = ["k;string", "i;int", "l;long", "f;float", "d;double", "b;boolean", "s;string"]
    out = encoded(df, schema, "k")
    assert len(out) == len(rows)
    for k, i, l, f, d, b, s in rows:
        assert out[k.encode()] == {
            "k": k.encode(),
            "i": struct.pack(">i", i),
            "l": struct.pack(">q", l),
            "f": struct.pack(">f", f),
            "d": struct.pack(">d", d),
            "b": b"\xff" if b else b"\x00",
            "s": f'{{"a":{s["a"]}}}'.encode(),
        }


def test_every_double_keeps_its_bits(spark):
    """Powers of two and their neighbours, subnormal numbers, zeros, infinities, random bits."""
    rng = random.Random(3)
    doubles = [0.0, -0.0, float("inf"), float("-inf"), 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308]
    for e in range(-1074, 1024):
        doubles += [2.0**e, -math.nextafter(2.0**e, 0), math.nextafter(2.0**e, math.inf)]
    doubles += [struct.unpack(">d", rng.randbytes(8))[0] for _ in range(5000)]
    doubles = [d for d in doubles if not math.isnan(d)]
    floats = [struct.unpack(">f", rng.randbytes(4))[0] for _ in range(5000)]
    floats += [s * 2.0**e * m for e in range(-149, 128) for s in (1, -1) for m in (1, 1.5) if e > -149 or m == 1]
    floats = [f for f in floats if not math.isnan(f)]
    for ddl, form, numbers in (("double", ">d", doubles), ("float", ">f", floats)):
        df = spark.createDataFrame(list(enumerate(numbers)), f"k int, x {ddl}")
        out = encoded(df, ["k;int", f"x;{ddl}"], "k")
        bad = [x for i, x in enumerate(numbers) if out[struct.pack(">i", i)]["x"] != struct.pack(form, x)]
        assert not bad
        nan = encoded(spark.sql(f"select 1 as k, cast('NaN' as {ddl}) as x"), ["k;int", f"x;{ddl}"], "k")
        assert nan[struct.pack(">i", 1)]["x"] == struct.pack(form, math.nan)


def test_known_bytes(spark):
    df = spark.sql("select 258 as a, -2 as b, 1.5D as c, 1.5F as d, 'Größe ≥ 3' as e")
    out = encoded(df, ["a;int", "b;int", "c;double", "d;float", "e;string"], "a")[bytes.fromhex("00000102")]
    assert {n: v.hex().upper() for n, v in out.items()} == {
        "a": "00000102",
        "b": "FFFFFFFE",
        "c": "3FF8000000000000",
        "d": "3FC00000",
        "e": "Größe ≥ 3".encode().hex().upper(),
    }


def test_nulls_and_types_without_encoding(spark):
    df = spark.sql(
        "select 'k' as k, cast(null as double) as d, cast(null as string) as s, 1S as sh, date'2020-01-01' as dt"
    )
    schema = ["key;string", "d;double", "s;string", "sh;short", "dt;date"]
    with pytest.warns(UserWarning, match="sh.*dt"):
        assert encoded(df, schema, "key") == {b"k": {"key": b"k"}}


def test_row_key_mistakes(spark):
    df = spark.sql("select cast(null as string) as k, 1S as sh")
    with pytest.warns(UserWarning), pytest.raises(PySparkException):
        wide_to_cells(df, ["k;string", "sh;short"], row="k", family="d").collect()
    with pytest.raises(TypeError):
        wide_to_cells(df, ["k;string", "sh;short"], row="sh", family="d")
    with pytest.raises(ValueError):
        wide_to_cells(df, ["k;string", "sh;short"], row="other", family="d")


def test_round_trip(spark):
    df = spark.createDataFrame([("a", "1", None), ("b", None, "2")], "k string, x string, y string")
    cells = wide_to_cells(df, ["k;string", "x;string", "y;string"], row="k", family="d")
    assert "Exchange" not in plan_of(cells)
    back = cells_to_wide(cells, ["d:k", "d:x", "d:y"])
    assert values(back.orderBy("rowkey")) == [("a", "a", "1", None), ("b", "b", None, "2")]


def test_cells_written_again_replace_the_earlier_ones(spark, tmp_path):
    path, schema = str(tmp_path / "cells"), ["k;string", "x;string", "y;string"]
    for rows in ([("a", "9", "z"), ("b", "9", None)], [("a", "1", None)]):
        write_cells(spark.createDataFrame(rows, "k string, x string, y string"), path, schema, row="k", family="d")
        time.sleep(0.01)
    back = cells_to_wide(spark.read.orc(path), ["d:x", "d:y"], version="version")
    assert values(back.orderBy("rowkey")) == [("a", "1", "z"), ("b", "9", None)]


def test_tasks_follow_the_cells_and_not_the_files(spark):
    """One file's cells are dealt to many tasks before they are sorted, a row key with most of them in parts."""
    cells = spark.range(0, 3_000, 1, 1).selectExpr(
        "if(id % 3 = 0, cast(id as string), 'hot') as rowkey", "'d' as family", "if(id % 2 = 0, 'a', 'b') as qualifier",
        "cast(id as string) as value", "id as version",
    )
    got = cells_to_wide(cells, ["d:a", "d:b"], version="version", task_cells=100)
    plan = plan_of(got)
    assert "hashpartitioning(rowkey" in plan and ", 30)" in plan
    rows = {r[0]: r[1:] for r in got.collect()}
    assert len(rows) == got.count() == 1_001
    assert rows["hot"] == ("2998", "2999") and rows["6"] == ("6", None) and rows["9"] == (None, "9")
