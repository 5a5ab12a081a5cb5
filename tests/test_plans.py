"""Plan-level checks: filters reach the scan, windows share one exchange, no cross products."""

import os
import tempfile

import pytest

from panelcast.operators import features as feat
from panelcast.sources import bars as B
from panelcast.sources import store as ST

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lineitem(spark):
    if not os.path.exists(f"{SF}/lineitem.parquet"):
        pytest.skip("test data not present")
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_extract_filters_reach_stored_bar_scan(spark, lineitem):
    path = tempfile.mkdtemp(prefix="panelcast-bars-") + "/bars"
    ST.write_table(B.bars_from_lineitem(lineitem), path)
    out = B.extract_bounded(spark.read.parquet(path), [1, 2], "1996-01-01", "1996-12-31", ["series_id", "bar_date", "close"])
    plan = _plan(out)
    assert "PushedFilters" in plan and "In(series_id" in plan and "GreaterThanOrEqual(bar_date" in plan
    assert "ReadSchema: struct<series_id:bigint,bar_date:date,close:double>" in plan


def test_series_filter_goes_below_the_window_into_the_raw_scan(spark, lineitem):
    out = B.extract_bounded(B.bars_from_lineitem(lineitem), [1, 2], "1996-01-01", "latest")
    plan = _plan(out)
    # The series key is the window's partition key, so it may move below it;
    # the date bound must stay above (it would change lag / pct_chg).
    assert "In(l_suppkey" in plan
    assert "l_shipdate" not in plan.split("PushedFilters")[1].split("]")[0] or "IsNotNull(l_shipdate)" in plan


def test_feature_windows_share_one_exchange(spark, lineitem):
    plan = _plan(feat.features_dataframe(B.bars_from_lineitem(lineitem)))
    import re

    # One exchange on the series key for every window (plus the bar aggregate's own).
    assert len(re.findall(r"Exchange hashpartitioning\(series_id#\d+L?, \d+\)", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_features_on_bucketed_panel_plan_without_exchange(spark, lineitem):
    import re

    from panelcast.plans import catalog

    plan = _plan(catalog.REGISTRY["features_bucketed"][0](spark, SF))
    assert "Bucketed: true" in plan
    assert not re.findall(r"Exchange hashpartitioning", plan)


def test_rows_are_dealt_before_any_is_sorted(spark, tmp_path):
    """A task that reads a split of the source sorts none of it; bars are those of all rows."""
    rows = spark.range(400).selectExpr(
        "id % 7 as l_suppkey", "id as l_orderkey", "int(id % 3) as l_linenumber", "timestamp(date_add(date'2020-01-01', int(id % 20))) as l_shipdate",
        "double(id) as l_extendedprice", "1d as l_quantity",
    )
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    bars = B.bars_from_lineitem(spark.read.parquet(f"{tmp_path}/lineitem.parquet"))
    lines = _plan(bars).splitlines()
    dealt = max(k for k, line in enumerate(lines) if "Exchange" in line)
    assert not any("Sort" in line for line in lines[dealt:])
    assert bars.count() == 140 and bars.agg({"vol": "sum"}).head()[0] == 400
