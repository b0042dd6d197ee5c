import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402

RUN_TS = datetime.datetime(2026, 8, 21, 8, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, app="tidemark-tests")
    yield session
    session.stop()


@pytest.fixture
def run_ts():
    return RUN_TS
