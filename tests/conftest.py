import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="panelcast-tests")
    yield s
    s.stop()


def daily(spark, closes, start="2021-01-01", series="s", extra=None):
    """A single-series bar table with consecutive days and the given closes."""
    import datetime as dt

    d0 = dt.date.fromisoformat(start)
    rows = []
    for i, c in enumerate(closes):
        c = None if c is None else float(c)
        rows.append((series, d0 + dt.timedelta(days=i), c, c, c, c, 1.0, 0.0))
    return spark.createDataFrame(
        rows,
        "series_id string, bar_date date, open double, high double, low double, close double, vol double, pct_chg double",
    )
