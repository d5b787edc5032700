import pytest

import __spark_entry__ as entry_point
from oracle.sql import ORACLE
from plaintlens.plans.queries import QUERIES
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert "complaints_per_billion_assets" in entry_point.entry(spark).columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], ORACLE[name], SF_DIR) == []


def test_comparison_notices_a_difference(spark, con):
    wrong = ORACLE["tier_rollup"].replace("1e9", "1.1e9")
    assert differences(spark, con, QUERIES["tier_rollup"], wrong, SF_DIR)
