"""Publishing partitions: reruns, stopped runs, several writers, readers under way."""

import pytest
from pyspark.sql import functions as F

from tabloom.plans import Flow
from tabloom.sinks import clean, publish_orc, published, read_published
from tabloom.sinks import publish as p

SCHEMA = ["id;long", "day;string", "kind;string"]


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/data"


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id bigint, day string, kind string")


def held(spark, path, **how):
    return sorted((tuple(r) for r in read_published(spark, path, **how).collect()), key=str)


def test_a_run_replaces_the_partitions_it_writes(spark, path):
    assert sorted(publish_orc(rows(spark, (1, "a", "x"), (2, "a", "y"), (3, "b", "x")), path, SCHEMA, ["day", "kind"])) == [
        "day=a/kind=x", "day=a/kind=y", "day=b/kind=x"
    ]
    publish_orc(rows(spark, (9, "a", "x")), path, SCHEMA, ["day", "kind"])
    assert held(spark, path) == [(2, "a", "y"), (3, "b", "x"), (9, "a", "x")]
    assert read_published(spark, path).columns == ["id", "day", "kind"]
    only = read_published(spark, path, F.col("partition").startswith("day=a/"))
    assert sorted(r.id for r in only.collect()) == [2, 9]


def test_a_rerun_leaves_one_copy_of_several_results(spark, path):
    def job():
        flow = Flow(spark).source("t", rows(spark, (1, "a", "x"), (2, "b", "x")))
        flow.result("select id, day, 'one' from t").result("select id + 10, day, 'two' from t")
        names = iter(("first", "second"))
        flow.save(lambda df: publish_orc(df, path, SCHEMA, ["day"], writer=next(names)))

    job()
    once = held(spark, path)
    job()
    assert held(spark, path) == once == [(1, "a", "one"), (11, "a", "two"), (12, "b", "two"), (2, "b", "one")]
    assert published(spark, path).count() == 4


def test_a_stopped_run_has_written_nothing(spark, path, monkeypatch):
    publish_orc(rows(spark, (1, "a", "x")), path, SCHEMA, ["day"])

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(p._Folder, "put", stop)
        with pytest.raises(KeyboardInterrupt):
            publish_orc(rows(spark, (2, "a", "x"), (3, "b", "x")), path, SCHEMA, ["day"])
    broken = rows(spark, (2, "a", "x")).withColumn("id", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        publish_orc(broken, path, SCHEMA, ["day"])
    assert held(spark, path) == [(1, "a", "x")]
    publish_orc(rows(spark, (2, "a", "x"), (3, "b", "x")), path, SCHEMA, ["day"])
    assert held(spark, path) == [(2, "a", "x"), (3, "b", "x")]


def test_a_whole_run_clears_what_its_writer_had(spark, path):
    publish_orc(rows(spark, (1, "a", "x"), (2, "b", "x")), path, SCHEMA, ["day"], writer="w")
    publish_orc(rows(spark, (3, "a", "x")), path, SCHEMA, ["day"], writer="v")
    publish_orc(rows(spark, (4, "c", "x")), path, SCHEMA, ["day"], writer="w", whole=True)
    assert held(spark, path) == [(3, "a", "x"), (4, "c", "x")]
    publish_orc(rows(spark).where("false"), path, SCHEMA, ["day"], writer="w", whole=True)
    assert held(spark, path) == [(3, "a", "x")]


def test_without_partitions_the_writer_has_one(spark, path):
    publish_orc(rows(spark, (1, "a", "x")), path, SCHEMA)
    publish_orc(rows(spark, (2, "a", "x")), path, SCHEMA)
    assert held(spark, path) == [(2, "a", "x")]


def test_odd_partition_values_keep_their_type(spark, path):
    days = [None, "", "01", "a=b/c", "ü 1", "50%"]
    publish_orc(rows(spark, *((i, d, "x") for i, d in enumerate(days))), path, SCHEMA, ["day"])
    # a text partition cannot tell an empty text from null
    assert held(spark, path) == sorted(((i, d or None, "x") for i, d in enumerate(days)), key=str)


def test_an_empty_first_run(spark, path):
    publish_orc(rows(spark).where("false"), path, SCHEMA, ["day"])
    assert held(spark, path) == []
    assert read_published(spark, path).columns == ["id", "day", "kind"]


def test_a_schema_is_kept(spark, path):
    publish_orc(rows(spark, (1, "a", "x")), path, SCHEMA, ["day"])
    with pytest.raises(ValueError, match="another schema"):
        publish_orc(rows(spark, (1, "a", "x")), path, SCHEMA, ["kind"])


def test_cleaning_deletes_what_is_in_force_no_more(spark, path):
    publish_orc(rows(spark, (1, "a", "x"), (2, "b", "x")), path, SCHEMA, ["day"])
    publish_orc(rows(spark, (3, "a", "x")), path, SCHEMA, ["day"])
    early = read_published(spark, path)
    assert clean(spark, path) == [] == clean(spark, path, older_than=0)
    publish_orc(rows(spark, (4, "a", "x"), (5, "b", "x")), path, SCHEMA, ["day"])
    assert sorted(r.id for r in early.collect()) == [2, 3]  # a reader under way keeps what it began with
    assert len(clean(spark, path, older_than=0)) == 2
    assert held(spark, path) == [(4, "a", "x"), (5, "b", "x")]
