"""One session for all tests, and the package on the path of Python workers."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([ROOT, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))

from pyspark.sql import SparkSession  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "2", "spark.default.parallelism": "2", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def data():
    if not Path(DATA).is_dir():
        pytest.skip("the given tables aren't here")
    return DATA
