"""Queries of the subpackage: registration, SQL where there is one, and native plans."""

import oracle
import pytest
from conftest import plan

import __spark_entry__ as contract
from spoorlens.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
NATIVE = ["op5_quality_rules", "op6_benchmark_decontamination", "op10_histogram_sharding"]
PYTHON = ["PythonUDF", "EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = oracle.connect(FOLDER)
    assert oracle.difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_native_plans(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not [node for node in PYTHON if node in text]
