import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from forecourt.session import build_session  # noqa: E402
from forecourt.sources import scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "4")
    yield session
    scratch.clear(session)
    session.stop()


@pytest.fixture(scope="session")
def hours():
    """A function from station, start and values to hourly rows."""

    def make(station, start, values):
        first = dt.datetime.fromisoformat(start)
        return [(station, first + dt.timedelta(hours=i), v) for i, v in enumerate(values)]

    return make


SERIES = "station_id long, timestamp timestamp_ntz, y double"
