"""Every query of the library against its SQL on the smallest tables, and all its plans."""

import oracle
import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as contract
from conftest import plan
from spoorlens.workload import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

# Python workers, and joins that compare all pairs.
NEVER = [
    "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "InPandas",
    "CartesianProduct", "BroadcastNestedLoopJoin",
]


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[:3] == ["season", "service_date", "hour"]


@pytest.fixture
def plans(monkeypatch):
    """Plans of the tables that a query writes on its way, staged ones included."""
    seen = []
    write = DataFrameWriter.parquet

    def watched(self, *args, **kwargs):
        seen.append(plan(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    collect = DataFrame.collect

    def collected(self):
        seen.append(plan(self))
        return collect(self)

    monkeypatch.setattr(DataFrame, "collect", collected)
    return seen


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, plans, name):
    df = QUERIES[name](spark, FOLDER)
    for text in [*plans, plan(df)]:
        for node in NEVER:
            assert node not in text, node
    assert oracle.difference(df, con, ORACLES[name]) is None
