import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="quayside-tests-"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Sorted tuples of a DataFrame."""

    def collect(df, *columns):
        taken = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in taken.collect()), key=repr)

    return collect
