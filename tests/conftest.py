import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tillworks.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A folder no other test uses."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
