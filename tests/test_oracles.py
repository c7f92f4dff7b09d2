"""Every registered query against its SQL twin."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from lakestrata.plans.oracles import ORACLES
from lakestrata.plans.queries import QUERIES

from comparison import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, database, ORACLES[name]) is None


def test_comparison_reports_a_wrong_oracle(spark, database):
    sql = contract.oracle_sql()["revenue_by_region_type"]
    wrong = f"SELECT region, event_type, total_revenue + 0.01 AS total_revenue, event_count FROM ({sql})"
    result = contract.queries()["revenue_by_region_type"](spark, SF_DIR)
    assert differences(result, database, wrong) is not None


def test_entry_runs(spark):
    result = contract.entry(spark)
    assert result.columns == ["region", "event_type", "total_revenue", "event_count"]
    assert result.count() > 0
