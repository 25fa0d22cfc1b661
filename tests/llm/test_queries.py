"""Every query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry_point
import oracle
from tabloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    got = oracle.spark_rows(QUERIES[name](spark, SF_DIR))
    wanted = oracle.duck_rows(oracle.connect(SF_DIR), ORACLES[name])
    assert got == wanted
    assert got[1], "no rows"


def test_all_are_registered():
    names = entry_point.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", ["op1_preference_format", "op4_digest_index", "op5_ring_sharding", "op6_divergence_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan
