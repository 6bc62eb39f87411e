from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import EDGES, SCHEMA  # noqa: E402


@pytest.fixture
def edges(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns whose names operators use themselves."""
    rows = [(*row, 1, "a", 0) for row in EDGES]
    return spark.createDataFrame(rows, f"{SCHEMA}, n long, node string, rank int")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
