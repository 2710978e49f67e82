import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridwright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ts():
    """Times by step: ts(3) is 30 minutes after the start, ts(3, 60) three hours."""
    start = datetime(2021, 1, 1)

    def at(i, minutes=10):
        return start + timedelta(minutes=i * minutes)

    return at
