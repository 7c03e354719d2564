from pathlib import Path

import pytest

import dropweave
import __spark_entry__ as entry
from check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
OWN = {name: query for name, query in entry.queries().items() if name.startswith("q_")}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(OWN) == {name for name in entry.oracle_sql() if name.startswith("q_")}


@pytest.mark.parametrize("name", list(OWN))
def test_query_agrees_with_sql(spark, con, name):
    df = OWN[name](spark, SF_DIR)
    assert compare(df, con, name) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "GlobalLimit"):
        assert node not in plan
    assert ("MapInArrow" in plan) == (name == "q_zip_scan")  # the other scan of archives ends in a stored manifest


def test_no_window_over_everything():
    """Only the list of sort partitions may go through a window without a partition clause."""
    package = Path(dropweave.__file__).parent
    found = [path.name for path in package.rglob("*.py") for line in path.read_text().splitlines()
             if "Window.orderBy" in line]
    assert found == ["ordering.py"]


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_lookup_opens_one_bucket(spark):
    plan = OWN["q_lookup_colocated"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "PushedFilters: [IsNotNull(key), EqualTo(key," in plan
