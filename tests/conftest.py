import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from tidewright.session import build_session
    session = build_session("tests", "local[4]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from tidewright.session import scratch_path
    return scratch_path(spark, "test")


def one(df):
    """The single value of a one-row, one-column result."""
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][0]
