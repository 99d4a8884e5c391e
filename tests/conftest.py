import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def make_events(spark):
    """Events from ``(stream_id, seq, ts_ms, message)`` tuples."""
    from logloom.schema import LOG_EVENTS

    return lambda rows: spark.createDataFrame(rows, LOG_EVENTS)
