"""Fixtures of the llm operators' tests."""

from __future__ import annotations

import os

import pytest

from .samples import AWKWARD, frame

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(autouse=True)
def _importable(spark):
    """Python workers import the package from here."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


@pytest.fixture
def awkward(spark):
    return frame(spark, AWKWARD).repartition(3)


@pytest.fixture
def nothing(spark):
    return frame(spark, [])
