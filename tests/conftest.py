"""One session for all tests; queries and their SQL side by side."""

from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    folder = tempfile.mkdtemp(prefix="spark-tests-")
    session = (
        SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[8]")).config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{folder}/shared").config("spark.sql.warehouse.dir", f"{folder}/warehouse").config("spark.driver.memory", "6g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
