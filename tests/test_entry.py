import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def test_entry_runs_on_smallest_scale(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["series_id", "bar_date"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
