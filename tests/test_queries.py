"""Every registered query against its oracle on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from placestats import session
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
CHECKED = set(entry.oracle_sql())
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture
def written_plans(monkeypatch):
    """The plans of all intermediate tables that a query writes."""
    plans = []
    monkeypatch.setattr(session, "on_plan", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    return plans


@pytest.mark.parametrize("name", sorted(CHECKED))
def test_matches_oracle(spark, con, name, written_plans):
    df = entry.queries()[name](spark, FOLDER)
    assert not [p for p in written_plans if "NestedLoop" in p or "Cartesian" in p]
    if not name.startswith("op"):
        assert not [p for p in written_plans if "Python" in p or "InPandas" in p or "InArrow" in p]
    assert compare(df, con, entry.oracle_sql()[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Python" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 25
