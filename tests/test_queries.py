"""Registered queries against their SQL on the smallest tables, all of them."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from billweave.plans import registry
from tools_check import compare

SF_DIR = os.environ.get("BILLWEAVE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = sorted(entry_points.oracle_sql())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    assert compare(spark, SF_DIR, name) is None


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["billing_period", "execution_id", "rows", "cost", "tagged"]
    assert frame.count() > 0
