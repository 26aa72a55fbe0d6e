"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract
from oracle import compare, duck
from statlake.plans import queries as registered

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_each_query_has_its_sql():
    assert set(registered.oracle_sql()) == set(registered.queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == contract.entry(spark).columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(registered.queries()))
@pytest.mark.filterwarnings("ignore:start/end ignored")
def test_query(spark, con, name):
    verdict, _ = compare(spark, con, SF, name, contract.queries()[name], contract.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict
