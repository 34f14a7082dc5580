"""Every registered query against its SQL twin on the smallest given tables."""

from pathlib import Path

import pytest
from oracle import compare, connect, type_differences

from workload.oracle_sql import SQL
from workload.spark_queries import REGISTRY

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIRECTORY).exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


def test_every_twin_has_a_query():
    assert set(SQL) <= set(REGISTRY)
    assert set(REGISTRY) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_values(spark, con, name):
    assert compare(spark, con, DIRECTORY, REGISTRY[name], SQL[name]) is None


@pytest.mark.parametrize("name", ["category_performance", "sales_lines", "decision_signals", "gen_bad_forecast"])
def test_same_types(spark, con, name):
    assert type_differences(REGISTRY[name](spark, DIRECTORY), con, SQL[name]) == {}
