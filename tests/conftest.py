from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillworks.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", spark__master="local[4]", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Apply a Column function to each text and return the results in order."""

    def run(function, texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
        return [r.v for r in df.select("i", function(df.c).alias("v")).orderBy("i").collect()]

    return run
