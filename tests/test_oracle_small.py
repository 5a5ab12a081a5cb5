"""Differential check at the smallest scale: Spark query vs its DuckDB oracle."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = [
    "bars_daily", "bars_orders", "features_dataframe", "features_sql", "training_frame", "clean_bars",
    "fold_membership", "sequences", "latest_window", "threshold_sweep", "stable_threshold",
    "roc_auc", "fold_results", "final_threshold_choice", "error_summary", "feature_consistency",
    "signal_export",
]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (v if v == 0.0 else float(f"{v:.9g}"))
    if hasattr(v, "isoformat"):
        return str(v)[:10]
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(f"{SF}/lineitem.parquet"):
        pytest.skip("test data not present")
    c = duckdb.connect()
    for t in ["lineitem", "orders", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)
