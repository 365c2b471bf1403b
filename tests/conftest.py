import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from gridtide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[8]", shuffle_partitions=8, conf={"spark.driver.memory": "6g", "spark.sql.ui.retainedExecutions": "100000"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as tuples, in a fixed order."""

    def collect(frame, *columns):
        chosen = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
