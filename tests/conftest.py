import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(shared))
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for the length of a block."""

    @contextmanager
    def changed(**values):
        names = {k.replace("__", "."): v for k, v in values.items()}
        before = {n: spark.conf.get(n, None) for n in names}
        try:
            for n, v in names.items():
                spark.conf.set(n, v)
            yield
        finally:
            for n, v in before.items():
                spark.conf.unset(n) if v is None else spark.conf.set(n, v)

    return changed


@pytest.fixture(params=["UTC", "GMT+08:00", "America/New_York"])
def zone(request, settings):
    """The same test under several session zones, one of them with daylight saving."""
    with settings(spark__sql__session__timeZone=request.param):
        yield request.param


def values(df, *names):
    """Rows as tuples (or bare values for one column), in the order of the input frame."""
    rows = df.select(*names).collect() if names else df.collect()
    return [r[0] if len(r) == 1 else tuple(r) for r in rows]


def plan_of(df):
    return df._jdf.queryExecution().toString()


def executed_plan(df):
    """The plan adaptive execution ended with, after running it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
