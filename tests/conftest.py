import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", master="local[8]", shuffle_partitions=8,
                          spark__ui__enabled="false", spark__driver__memory="8g",
                          spark__sql__autoBroadcastJoinThreshold=os.environ.get("TEST_BROADCAST_LIMIT", "10m"),
                          spark__sql__session__timeZone=os.environ.get("TEST_TIME_ZONE", "UTC"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
