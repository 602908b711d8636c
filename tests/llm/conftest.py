"""Awkward rows that every operator of documents must take."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import AWKWARD  # noqa: E402



@pytest.fixture
def awkward(spark):
    """Nulls, empty and long texts, repeats, special strings, and columns whose names clash with those that operators use."""
    rows = [(i, t, "x", 1, 2, 3, "k") for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, row int, key int, shard int, host string").repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
