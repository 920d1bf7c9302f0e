import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quartermill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", cores=8)


def month_starts(n, start=dt.date(2022, 1, 1), step=1):
    first = start.year * 12 + start.month - 1
    return [dt.date((first + i * step) // 12, (first + i * step) % 12 + 1, 1) for i in range(n)]


PANEL = "series_id string, date date, y double"


@pytest.fixture(scope="session")
def retail(spark):
    rows = [("a", d, 5000.0 + 50 * i) for i, d in enumerate(month_starts(24))]
    return spark.createDataFrame(rows, PANEL)


@pytest.fixture(scope="session")
def seasonal_panel(spark):
    """Two series with an exact line plus an exact quarterly pattern."""
    wave = [10.0, -4.0, -8.0, 2.0]
    rows = []
    for name, level, slope in (("up", 200.0, 3.0), ("down", 400.0, -2.0)):
        rows += [(name, d, level + slope * i + wave[i % 4]) for i, d in enumerate(month_starts(40, dt.date(2000, 3, 1), 3))]
    return spark.createDataFrame(rows, PANEL)
