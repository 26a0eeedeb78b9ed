"""Every query with checking SQL gives the same names, types, row count and values in both engines."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests import compare

DIR = os.environ.get("TELEQUAL_CHECK_DIR", "/root/testdata/sf0.001")
SLOW = {"churn_score", "churn_evaluation"}


@pytest.fixture(scope="module")
def con():
    return compare.connect(DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare.compare(contract.queries()[name](spark, DIR), con, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql()) - SLOW))
def test_query_without_sql_returns_rows(spark, name):
    assert contract.queries()[name](spark, DIR).count() > 0


def test_entry_returns_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["entity", "n_readings", "n_breaches", "breach_rate"]
    assert df.count() > 0
