"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

import __spark_entry__ as E
from paneltide.plans import catalog
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    """All but those of the optional package, which have tests of their own."""
    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert res["ok"], res


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "traj_cat_simple" in df.columns
