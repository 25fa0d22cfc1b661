import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
import oracle
from tabloom.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, duck, name):
    got = oracle.spark_rows(QUERIES[name](spark, SF_DIR))
    wanted = oracle.duck_rows(duck, ORACLES[name])
    assert got == wanted
    assert got[1], "no rows"


@pytest.mark.parametrize("name", ["expr_strftime", "expr_strptime", "expr_dateformat", "src_partition_scan"])
def test_session_zone_does_not_matter(spark, duck, settings, name):
    with settings(spark__sql__session__timeZone="America/New_York"):
        got = oracle.spark_rows(QUERIES[name](spark, SF_DIR))
    assert got == oracle.duck_rows(duck, ORACLES[name])


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_the_entry_goes_on_without_libraries_of_its_own():
    """What only the training-data operators need may be missing."""
    code = (
        "import sys, warnings; sys.modules['tiktoken'] = None; warnings.simplefilter('ignore'); import __spark_entry__ as e;"
        "from tabloom.queries import QUERIES; assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(QUERIES)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, check=True)
