"""Every registered query against its SQL, and the shape of every plan."""

import re

import pytest

import __spark_entry__ as registered
import check
from catalog.registry import ORACLES, QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, con, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    assert check.differences(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoop|Cartesian", plan), "a cross join slipped in"
    assert "Python" not in plan and "Pandas" not in plan


def test_entry_runs(spark):
    assert registered.entry(spark).count() > 0
