import pytest

import __spark_entry__ as entry
from checks.queries import ORACLES, QUERIES
from checks.compare import compare, duckdb_over

SF = "/root/testdata/sf0.001"
# Empty at the smallest scale factor only; compared at the next one up.
LARGER = {"attr_and_bbox": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def connections():
    return {sf: duckdb_over(sf) for sf in (SF, *LARGER.values())}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, connections, name):
    sf = LARGER.get(name, SF)
    df = entry.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"))
    assert compare(df, connections[sf], entry.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
