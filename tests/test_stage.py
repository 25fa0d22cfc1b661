import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import plan_of, values
from tabloom import functions as fn
from tabloom.operators import Dimension, dimension, project, project_json, rename_to, stage, stages, strip_prefix
from tabloom.schema import declare, struct


@pytest.fixture
def df(spark):
    return spark.createDataFrame([("1", "2")], "a string, b string")


def test_outputs_read_the_input(df):
    out = stage(df, {"a": "b", "b": "a", "c": fn.add("a", "b")})
    assert out.columns == ["a", "b", "c"]
    assert values(out) == [("2", "1", "12")]
    assert values(df) == [("1", "2")]


def test_siblings_are_invisible(df):
    with pytest.raises(ValueError):
        stage(df, {"c": "a", "d": "c"})
    with pytest.raises(AnalysisException):
        stage(df, {"c": "a", "d": F.col("c")})
    assert values(stages(df, [{"c": "a"}, {"d": "c"}]), "d") == ["1"]


def test_missing_column_may_be_null(df):
    assert values(stage(df, {"c": "absent"}, missing_as_null=True), "c") == [None]


def test_names_with_family_and_dots(spark):
    wide = spark.createDataFrame([("x", "y")], "`d:k` string, `p.q` string")
    assert values(stage(wide, {"a": "d:k", "b": fn.add("p.q", "d:k")}), "a", "b") == [("x", "yx")]


def test_whole_job(spark):
    """Wide text columns, a dimension, and a schema in another order."""
    source = spark.createDataFrame([("Oak", "12", "m3")], "`w:wood` string, `w:volume` string, `w:unit` string")
    factors = Dimension(spark.createDataFrame([("l", "0.001"), ("m3", "1")], "unit string, factor string"))
    out = stage(source, {"wood": "w:wood", "volume": "w:volume", "factor": dimension(factors, "w:unit")})
    shaped = project(out, ["factor;double", "wood;string", "volume;int"])
    assert values(shaped) == [(1.0, "Oak", 12)]


def test_filter_and_pruning_pass_through_a_stage(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    nation = Dimension(spark.read.parquet("/root/testdata/sf0.001/nation.parquet").select("n_nationkey", "n_name"))
    out = stage(orders, {"p": fn.to_int(F.substring("o_orderpriority", 1, 1)), "n": dimension(nation, "o_custkey")})
    plan = plan_of(out.where("o_orderkey < 10").select("o_orderkey", "n"))
    assert "LessThan(o_orderkey,10)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_project(spark):
    df = spark.createDataFrame([("7", 1.5, "x")], "a string, b double, extra string")
    out = project(df, ["b;float", "missing;date", "a;int"])
    assert out.dtypes == [("b", "float"), ("missing", "date"), ("a", "int")]
    assert values(out) == [(1.5, None, 7)]


def test_schema_declaration():
    names = ["int", "string", "boolean", "date", "double", "float", "long", "short", "timestamp"]
    schema = struct([f"c{i};{t}" for i, t in enumerate(names)])
    assert [f.dataType.simpleString() for f in schema] == [
        "int", "string", "boolean", "date", "double", "float", "bigint", "smallint", "timestamp",
    ]
    assert all(f.nullable for f in schema)
    assert declare(["f3;string;concat('a;', b)"])[0].default == "concat('a;', b)"
    for bad in (["a;decimal"], ["a;int", "a;string"], ["a"]):
        with pytest.raises(ValueError):
            declare(bad)


def test_rename_by_position_swaps(df):
    out = rename_to(df, ["b;string", "a;int"])
    assert out.dtypes == [("b", "string"), ("a", "string")]
    assert values(out, "a", "b") == [("2", "1")]
    assert rename_to(df, ["b;string", "a;int"], cast=True).dtypes[1] == ("a", "int")
    with pytest.raises(ValueError):
        rename_to(df, ["a;string"])


def test_strip_prefix(spark):
    fields = {"key": "k-9", "w:wood": "Öl-Eiche", "w:volume": "12", "w:unit": "m3"}
    wide = spark.createDataFrame([tuple(fields.values())], ", ".join(f"`{n}` string" for n in fields))
    out = strip_prefix(wide, ["w:unit", "w:wood", "w:volume"])
    assert out.columns == ["unit", "wood", "volume"]
    assert values(out) == [("m3", "Öl-Eiche", "12")]
    assert values(strip_prefix(wide, ["w:unit", "w:none"])) == [("m3", None)]
    for bad in (["a:b:c"], ["w:unit", "v:unit"]):
        with pytest.raises(ValueError):
            strip_prefix(wide, bad)


def test_project_json(spark):
    wide = spark.createDataFrame([("k", 1, None, "z")], "rowkey string, `d:n` int, `d:none` string, `a:b:c` string")
    out = project_json(wide, ["rowkey", "d:n", "d:none", "a:b:c", "absent"])
    assert values(out) == ['{"rowkey":"k","n":1}']
