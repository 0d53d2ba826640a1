import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(__file__)), os.path.dirname(__file__)]


@pytest.fixture(scope="session")
def spark():
    from fieldlake.session import build_session

    session = build_session("fieldlake-tests", master="local[8]", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
