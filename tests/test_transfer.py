import uuid
from pathlib import Path
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import plan_of, values
from tabloom import functions as fn
from tabloom.durable import new_folder, shared_folder
from tabloom.operators import Dimension, RangeDimension, dimension, in_range
from tabloom.plans import Flow, generated_select
from tabloom.sinks import add_partitions, output_width, register_orc_table, write_jdbc, write_orc
from tabloom.sources import empty_table, has_data, read_dimensions, read_partition, read_query

SCHEMA = ["id;long", "name;string", "year;int", "month;int"]


@pytest.fixture
def rows(spark):
    return spark.range(48).select(
        "id",
        F.concat(F.lit("n"), "id"),
        (F.lit(2016) + F.col("id") % 2).cast("int"),
        (F.col("id") % 12 + 1).cast("int"),
    )


@pytest.fixture
def dataset(rows, tmp_path):
    path = str(tmp_path / "it's a table")
    write_orc(rows, path, SCHEMA, ["year", "month"])
    return path


def test_has_data(spark, tmp_path):
    root = tmp_path / "p"
    assert not has_data(spark, str(root))
    (root / "deep" / "er").mkdir(parents=True)
    for name in (".hidden", "part.tmp", "_SUCCESS", "_success", "_Fail"):
        (root / "deep" / name).write_text("x")
        assert not has_data(spark, str(root)), name
    for folder in ("_temporary/0", ".staging", "deep/_tmp/k=1"):
        (root / folder).mkdir(parents=True)
        (root / folder / "part-0.orc").write_text("x")
        assert not has_data(spark, str(root)), folder
    (root / "deep" / "_k=1").mkdir()
    (root / "deep" / "_k=1" / "part-0").write_text("x")
    assert has_data(spark, str(root))
    assert has_data(spark, str(root / "deep/_tmp"))


def test_partition_scan(spark, dataset):
    one = read_partition(spark, dataset, f"{dataset}/year=2016")
    assert set(one.columns) == {"id", "name", "year", "month"}
    assert {r.year for r in one.collect()} == {2016} and one.count() == 24
    assert read_partition(spark, dataset).count() == 48


def test_partition_pruning(spark, dataset):
    plan = plan_of(read_partition(spark, dataset).where("year = 2016 and id < 5").select("id"))
    assert "PartitionFilters: [isnotnull(year" in plan and "LessThan(id,5)" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_given_schema(spark, dataset, tmp_path):
    schema = spark.createDataFrame([], "id long, name string").schema
    assert read_partition(spark, dataset, source_schema=schema).count() == 48
    empty = tmp_path / "empty"
    empty.mkdir()
    assert read_partition(spark, str(empty), source_schema=schema).count() == 0


def test_flow_over_a_partition_without_data(spark, dataset, tmp_path):
    schema = ["name;string", "code;int"]
    steps = [{"code": fn.to_int(F.substring("name", 2, 9))}]
    flow = Flow(spark)
    flow.partition_source("some", dataset, f"{dataset}/year=2017", schema, steps)
    flow.partition_source("none", dataset, f"{dataset}/year=2099", schema, steps)
    flow.result("select count(*), sum(code) from some").result("select count(*), sum(code) from none")
    assert values(flow.union()) == [(24, sum(range(1, 48, 2))), (0, None)]
    assert empty_table(spark, ["a;int", "b;timestamp"]).dtypes == [("a", "int"), ("b", "timestamp")]


def test_gathered_write_has_few_files(rows, spark, tmp_path):
    path = tmp_path / "gathered"
    write_orc(rows.repartition(8), str(path), SCHEMA, ["year"], gather=True)
    assert {len(list(p.glob("part-*"))) for p in path.glob("year=*")} == {1}
    assert read_partition(spark, str(path)).count() == 48


def test_hot_partition_is_split_when_gathered(spark, settings, tmp_path):
    path = tmp_path / "hot"
    hot = (F.col("id") % 50 == 0).cast("int").alias("p")
    df = spark.range(0, 300_000, numPartitions=8).select(F.rand(1).alias("x"), hot)
    with settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB"):
        write_orc(df, str(path), ["x;double", "p;int"], ["p"], gather=True)
    assert len(list((path / "p=0").glob("part-*"))) > 1
    assert spark.read.orc(str(path)).count() == 300_000


def test_save_modes_and_width(rows, spark, tmp_path):
    path = tmp_path / "t"
    for shuffle in (False, True):
        write_orc(rows.repartition(8), str(path), SCHEMA, partitions=2, shuffle=shuffle, mode="overwrite")
        assert len(list(path.glob("part-*"))) == 2
    write_orc(rows, str(path), SCHEMA, mode="append")
    assert spark.read.orc(str(path)).count() == 96
    with pytest.raises(AnalysisException):
        write_orc(rows, str(path), SCHEMA)
    assert output_width(rows.repartition(8), None).rdd.getNumPartitions() == 8


def test_written_types(spark, tmp_path):
    df = spark.createDataFrame([("7",)], "a string")
    write_orc(df, str(tmp_path / "raw"), ["a;int"])
    write_orc(df, str(tmp_path / "cast"), ["a;int"], cast=True)
    assert [spark.read.orc(str(tmp_path / n)).dtypes for n in ("raw", "cast")] == [[("a", "string")], [("a", "int")]]


def test_register_table(spark, dataset):
    name = f"t_{uuid.uuid4().hex}"
    out = register_orc_table(spark, name, dataset, SCHEMA, ["year", "month"])
    assert dict(out.dtypes) == {"id": "bigint", "name": "string", "year": "string", "month": "string"}
    assert spark.table(name).where("year = '2016' and month = '1'").count() == 4
    with pytest.raises(ValueError):
        register_orc_table(spark, "x", dataset, SCHEMA, ["day"])


def test_partitions_just_written_are_added_without_a_listing(spark, tmp_path):
    path, name = f"{tmp_path}/days", f"t_{uuid.uuid4().hex}"
    schema = ["id;long", "day;string"]
    days = ["a", "it's", "b"]

    def write(some):
        rows = [(k, d) for k, d in enumerate(some)]
        write_orc(spark.createDataFrame(rows, "id bigint, day string"), path, schema, ["day"], mode="append")

    write(days)
    register_orc_table(spark, name, path, schema, ["day"], find=False)
    assert spark.table(name).count() == 0
    add_partitions(spark, name, [{"day": d} for d in days], at_once=2)
    assert sorted(r.day for r in spark.table(name).collect()) == sorted(days)
    write(["c", "a"])
    add_partitions(spark, name, [{"day": "c"}, {"day": "a"}])
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 5
    add_partitions(spark, name, [])


class Recorder:
    """Stands in for a reader or writer and keeps what it was told; no database is started."""

    def __init__(self, result=None):
        self.calls, self.result = [], result

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self.result if name == "load" else self

        return call


class FakeSession:
    def __init__(self, result):
        self.read = Recorder(result)


def test_jdbc_read(spark):
    session = FakeSession(spark.createDataFrame([("1", "a")], "k string, v string"))
    read_query(session, "jdbc:x:y", "select k, v from t;", {"user": "u", "fetchsize": "1000"})
    calls = {(n, *a) if a else (n, *sorted(kw.items())) for n, a, kw in session.read.calls}
    assert ("option", "dbtable", "(select k, v from t) q") in calls
    assert ("option", "url", "jdbc:x:y") in calls and ("format", "jdbc") in calls
    assert ("options", ("fetchsize", "1000"), ("user", "u")) in calls


def test_jdbc_dimensions(spark):
    session = FakeSession(spark.createDataFrame([("1", "a")], "k string, v string"))
    dims = read_dimensions(session, "jdbc:x:y", {"one": "select 1", "two": ["select 2", "select 3"]})
    assert [len(dims[a].maps) for a in ("one", "two")] == [1, 2]
    out = Flow(spark).dimension("one", dims["one"])
    out.source("facts", spark.createDataFrame([(1,)], "x int"), [{"v": dimension("one", "x")}])
    assert values(spark.table("facts"), "v") == ["a"]


def test_jdbc_queries_with_options_of_their_own(spark):
    session = FakeSession(spark.createDataFrame([("1", "a")], "k string, v string"))
    parallel = {"partitionColumn": "k", "numPartitions": "8", "lowerBound": "0", "upperBound": "9"}
    queries = {"small": "select 1", "large": ("select 2", parallel), "both": [("select 3", {"url": "jdbc:p:q"}), "select 4"]}
    read_dimensions(session, "jdbc:x:y", queries, {"user": "u", "numPartitions": "1"})
    urls = [a[1] for n, a, _ in session.read.calls if n == "option" and a[0] == "url"]
    options = [kw for n, _, kw in session.read.calls if n == "options"]
    assert urls == ["jdbc:x:y", "jdbc:x:y", "jdbc:p:q", "jdbc:x:y"]
    common = {"user": "u", "numPartitions": "1"}
    assert options == [common, {**common, **parallel}, common, common]


def test_jdbc_write(monkeypatch, spark):
    written = []
    from pyspark.sql import DataFrameWriter

    def jdbc(self, url, table, properties):
        written.append((url, table, properties, self._df.columns, self._df.rdd.getNumPartitions()))

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    df = spark.range(8).repartition(4)
    write_jdbc(df, "jdbc:x:y", "t", ["key;long"], options={"user": "u", "batchsize": "5000"}, partitions=2)
    assert written == [("jdbc:x:y", "t", {"user": "u", "batchsize": "5000"}, ["key"], 2)]


SELECT_SCHEMA = ["run;string;7", "status;string;'new'", "invoice;string", "amount;double;price * pieces", "buyer;string"]


def test_generated_select(spark):
    """Defaults of the schema, overrides, a name the schema lacks, and a join with a condition."""
    spark.sql("select 'R-1' invoice, 'Ann' buyer, 2.5D price, 4 pieces").createOrReplaceTempView("bills")
    out = generated_select(spark, SELECT_SCHEMA, {"run": "8", "buyer": "upper(buyer)", "nobody": "1"}, "bills", "pieces > 3")
    assert out.columns == ["run", "status", "invoice", "amount", "buyer"]
    assert values(out) == [(8, "new", "R-1", 10.0, "ANN")]
    spark.sql("select 'R-1' bill, 'paid' note union all select 'R-2', 'open'").createOrReplaceTempView("notes")
    out = generated_select(
        spark, SELECT_SCHEMA, {"status": "note"}, "bills left join notes on bills.invoice = notes.bill", "note = 'paid' or price < 1"
    )
    assert values(out) == [(7, "paid", "R-1", 10.0, "Ann")]


def test_generated_select_sees_only_the_source(spark):
    spark.sql("select 1 a").createOrReplaceTempView("only_a")
    with pytest.raises(AnalysisException):
        generated_select(spark, ["x;int;a", "y;int;x + 1"], {}, "only_a")
    with pytest.raises(ValueError):
        generated_select(spark, ["x;int"], {}, "")


def test_flow(spark, tmp_path):
    flow = Flow(spark).source("numbers", spark.range(30), schema=["id;int"])
    flow.table("even", "select id from numbers where id % 2 = 0", partition_by="id", persist=True)
    assert spark.table("even").storageLevel.useMemory
    spark.table("even").unpersist()
    assert flow.preview("select id from numbers order by id", show=False).count() == 20
    flow.result("select id, 'even' as kind from even").result("select id + 100, 'all' from numbers")
    assert flow.union().count() == 45 and flow.union().columns == ["id", "kind"]
    path = str(tmp_path / "out")
    flow.save(lambda df: write_orc(df, path, ["n;int", "kind;string"], mode="append"))
    assert spark.read.orc(path).count() == 45
    flow.save(lambda df: write_orc(df, path, ["n;int", "kind;string"], mode="overwrite"), union=True)
    assert spark.read.orc(path).groupBy("kind").count().orderBy("kind").collect()[0]["count"] == 30


def test_named_table_splits_a_hot_key(spark, settings):
    key = F.when(F.col("id") % 50 == 0, F.col("id") % 500).otherwise(F.lit(1)).alias("key")
    rows = spark.range(0, 300_000, numPartitions=8).select(F.rand(1).alias("x"), key)
    with settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB"):
        Flow(spark).source("raw", rows).table("by_key", "select * from raw", partition_by="key")
        place = spark.table("by_key").select("key", "x", F.spark_partition_id().alias("task"))
        by_key = place.groupBy("key").agg(F.collect_set("task").alias("tasks"), F.max("x"))
        tasks = {r.key: len(r.tasks) for r in by_key.collect()}
    # keys that hash into the hot key's partition are split along with it, the others are not
    assert tasks[1] > 1 and min(tasks.values()) == 1


def test_flow_without_results(spark):
    with pytest.raises(ValueError):
        Flow(spark).union()
    with pytest.raises(ValueError):
        Flow(spark).save(print)


def test_a_flow_leaves_the_session_alone(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.forceOptimizeSkewedJoin"]
    before = [spark.conf.get(n, None) for n in names]
    seen = []
    first = Flow(spark, shuffle_partitions=3).source("a_few", spark.range(9)).result("select id from a_few")
    second = Flow(spark, shuffle_partitions=20).source("a_few_more", spark.range(9)).result("select id from a_few_more")
    for flow in (first, second, first):
        flow.save(lambda df: seen.append([spark.conf.get(n) for n in names]))
    assert seen == [["3", "true"], ["20", "true"], ["3", "true"]]
    with pytest.raises(ZeroDivisionError):
        first.save(lambda df: 1 / 0)
    assert [spark.conf.get(n, None) for n in names] == before


def test_closing_a_flow_releases_what_it_holds(spark):
    lookup = Dimension(spark.createDataFrame([("k", "v")], "k string, v string"))
    bands = RangeDimension(spark.createDataFrame([("1_2", "x")], "k string, v string"))
    with Flow(spark).dimension("d", lookup).dimension("r", bands) as flow:
        facts = spark.createDataFrame([("k", 1)], "k string, n int")
        flow.source("held", facts, [{"v": dimension("d", "k"), "b": in_range("r", "n")}], persist=True)
        assert values(spark.table("held"), "v", "b") == [("v", "x")]
        folders = [Path(urlparse(x).path) for x in (lookup._folder.path(spark), bands.folder.path(spark))]
        assert all(any(f.iterdir()) for f in folders) and spark.table("held").storageLevel.useMemory
    assert not any(f.exists() for f in folders)
    assert not spark.table("held").storageLevel.useMemory


def test_later_dimension_replaces(spark):
    a, b = (Dimension(spark.createDataFrame([("k", v)], "k string, v string")) for v in "ab")
    flow = Flow(spark).dimension("d", a).dimension("d", b)
    flow.source("looked", spark.createDataFrame([("k",)], "k string"), [{"v": dimension("d", "k")}])
    assert values(spark.table("looked"), "v") == ["b"]


@pytest.mark.parametrize(
    "master, setting, file_system, folder",
    [
        ("spark://host:7077", "s3a://bucket/tmp/", "file:///", "s3a://bucket/tmp"),
        ("spark://host:7077", "file:///mnt/shared", "file:///", "file:///mnt/shared"),
        ("yarn", "/jobs/tmp", "hdfs://nn:8020", "/jobs/tmp"),
        ("yarn", None, "hdfs://nn:8020", "/tmp/tabloom-ann"),
        ("yarn", None, "file:///", None),
        ("local[4]", "/scratch", "file:///", "/scratch"),
    ],
)
def test_shared_folder_of_a_cluster(master, setting, file_system, folder):
    """A folder of one machine is never used on a cluster."""

    def get(value):
        return SimpleNamespace(get=lambda key, default=None: value)

    java_context = SimpleNamespace(hadoopConfiguration=lambda: get(file_system))
    context = SimpleNamespace(
        master=master, getConf=lambda: get(setting), _jsc=java_context, sparkUser=lambda: "ann"
    )
    session = SimpleNamespace(conf=get(None), sparkContext=context)
    if folder is None:
        with pytest.raises(RuntimeError):
            shared_folder(session)
    else:
        assert shared_folder(session) == folder


def test_folders(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
