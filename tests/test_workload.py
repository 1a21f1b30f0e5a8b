"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
import compare
from workload import oracle
from workload.inputs import Inputs
from workload.queries import REGISTRY

SF = "/root/testdata/sf0.001"
# Operators that emit all pairs, or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "InPandas")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def shared(spark):
    """One set of inputs for all queries, so the flows are computed once."""
    return Inputs(spark, SF)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_same_as_sql(shared, db, name):
    frame = REGISTRY[name](shared)
    got = compare.rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = db.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert got == compare.rows(columns, cursor.fetchall())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [name for name in UNWANTED if name in plan]


def test_every_query_has_sql():
    """Of the text operators, those that SQL cannot express are named in their own tests."""
    assert set(REGISTRY) == set(oracle.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() >= 12
