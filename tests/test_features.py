import math

from pyspark.sql import functions as F

from conftest import daily
from panelcast.operators import features as feat
from panelcast.schema import FEATURE_COLUMNS
from panelcast.sources import bars as B


def _rows(df):
    return df.orderBy("bar_date").collect()


def test_last_row_label(spark):
    f = _rows(feat.features_dataframe(daily(spark, [1, 2, 3, 2, 5])))
    assert [r["target_up"] for r in f] == [1, 1, 0, 1, 0]
    d = _rows(feat.features_dataframe(daily(spark, [1, 2, 3, 2, 5]), label_tail="drop"))
    assert d[-1]["target_up"] is None and d[0]["target_up"] == 1
    s = _rows(feat.features_sql(daily(spark, [1, 2, 3, 2, 5]), label_tail="drop"))
    assert s[-1]["target_up"] is None and [r["target_up"] for r in s[:-1]] == [1, 1, 0, 1]


def test_zero_close_gives_null_return(spark):
    f = _rows(feat.features_dataframe(daily(spark, [1, 0, 3, 4])))
    assert f[2]["ret_1"] is None and f[1]["ret_1"] == -1.0


def test_null_close(spark):
    closes = [float(i + 1) for i in range(12)]
    closes[6] = None
    f = _rows(feat.features_dataframe(daily(spark, closes)))
    assert f[6]["ret_1"] is None and f[7]["ret_1"] is None
    assert f[6]["ma5"] is None and f[10]["ma5"] is None and f[11]["ma5"] is not None
    assert f[6]["target_up"] == 0 and f[5]["target_up"] == 0


def test_moving_average_full_frame(spark):
    f = _rows(feat.features_dataframe(daily(spark, range(1, 8))))
    assert f[3]["ma5"] is None and f[4]["ma5"] == 3.0 and f[6]["ma5"] == 5.0


def test_sample_vs_population_volatility(spark):
    import random

    rnd = random.Random(7)
    closes = [100.0]
    for _ in range(40):
        closes.append(closes[-1] * (1 + rnd.uniform(-0.05, 0.05)))
    bars = daily(spark, closes)
    a = _rows(feat.features_dataframe(bars, ddof=1))
    b = _rows(feat.features_sql(bars, ddof=0))
    for n in (5, 10, 20):
        r = a[30][f"volatility_{n}"] / b[30][f"volatility_{n}"]
        assert math.isclose(r, math.sqrt(n / (n - 1)), rel_tol=1e-12)


def test_dataframe_and_sql_forms_agree(spark):
    import random

    rnd = random.Random(3)
    closes = [50 + rnd.random() * 10 for _ in range(60)]
    bars = daily(spark, closes, series="a").unionByName(daily(spark, closes[::-1], series="b"))
    a = feat.features_dataframe(bars, ddof=0)
    b = feat.features_sql(bars, ddof=0)
    cols = ["series_id", "bar_date", *FEATURE_COLUMNS, "target_up"]
    ja = {(r[0], r[1]): r for r in a.select(*cols).collect()}
    for r in b.select(*cols).collect():
        o = ja[(r[0], r[1])]
        for c in FEATURE_COLUMNS:
            x, y = o[c], r[c]
            assert (x is None and y is None) or math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-15), c
        assert o["target_up"] == r["target_up"]


def test_engine_dispatch_rejects_unknown(spark):
    import pytest

    with pytest.raises(ValueError):
        feat.build_features(daily(spark, [1, 2]), form="polars")


def test_date_forms_and_bad_values(spark):
    raw = spark.createDataFrame(
        [
            ("a", "20210104", "1", "1", "1", "1", "1", "0"),
            ("a", "2021-01-05", "2", "2", "2", "2", "2", "0"),
            ("a", "2021/01/06", "abc", "3", "3", "3", "3", "0"),
            ("a", "x", "4", "4", "4", "4", "4", "0"),
        ],
        "series_id string, bar_date string, open string, high string, low string, close string, vol string, pct_chg string",
    )
    out = B.clean_bars(raw).orderBy("bar_date").collect()
    assert [str(r["bar_date"]) for r in out] == ["2021-01-04", "2021-01-05", "2021-01-06"]
    assert out[2]["open"] is None and out[2]["close"] == 3.0


def test_required_columns_checked_before_any_job(spark):
    import pytest

    df = spark.createDataFrame([("2021-01-01", 1.0)], "bar_date string, close double")
    with pytest.raises(ValueError, match="high, low, open, pct_chg, vol"):
        B.clean_bars(df)


def test_bars_from_lineitem_open_close(spark):
    rows = [
        (1, 1, 7, 1, 1.0, 10.0, "2021-01-01 00:00:00"),
        (2, 1, 7, 1, 2.0, 30.0, "2021-01-01 00:00:00"),
        (2, 1, 7, 1, 2.0, 20.0, "2021-01-01 00:00:00"),  # same key, price breaks the tie
        (3, 1, 7, 2, 1.0, 15.0, "2021-01-02 00:00:00"),
    ]
    li = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate string")
    li = li.withColumn("l_shipdate", F.to_timestamp("l_shipdate"))
    out = B.bars_from_lineitem(li).orderBy("bar_date").collect()
    assert (out[0]["open"], out[0]["close"], out[0]["high"], out[0]["low"], out[0]["vol"]) == (10.0, 30.0, 30.0, 10.0, 5.0)
    assert out[0]["pct_chg"] is None and math.isclose(out[1]["pct_chg"], 100 * (15 / 30 - 1))


def test_two_moment_population_volatility_matches_builtin(spark):
    import random

    rnd = random.Random(9)
    closes = [100.0]
    for _ in range(40):
        closes.append(closes[-1] * (1 + rnd.uniform(-0.03, 0.03)))
    bars = daily(spark, closes)
    a = _rows(feat.features_sql(bars, ddof=0))
    b = _rows(feat.features_sql(bars, ddof=0, std_form="two_moment"))
    for x, y in zip(a, b):
        for n in (5, 10, 20):
            u, v = x[f"volatility_{n}"], y[f"volatility_{n}"]
            assert (u is None and v is None) or math.isclose(u, v, rel_tol=1e-6, abs_tol=1e-12)


def test_date_bounds():
    import datetime as dt

    import pytest

    assert B.normalize_date_bound("20210104") == dt.date(2021, 1, 4)
    assert B.normalize_date_bound("2021-01-04") == dt.date(2021, 1, 4)
    assert B.normalize_date_bound(" 2021/01/04 ") == dt.date(2021, 1, 4)
    assert B.normalize_date_bound("latest", today=dt.date(2026, 1, 2)) == dt.date(2026, 1, 2)
    with pytest.raises(ValueError):
        B.normalize_date_bound("04.01.2021")


def test_date_text_must_match_to_its_end(spark):
    texts = ["2021-01-04", "2021/01/04", "20210104", " 2021-01-04 ", "2021-01-04 10:11:12", "2021-01-04T10:11:12", "2021-01-04 10:11:12.123456"]
    bad = ["2021-01-04garbage", "2021-01-0499", "2021/01/04 xx", "x", "", None, "2021-13-01"]
    raw = spark.createDataFrame([(str(i), t, *["1"] * 6) for i, t in enumerate(texts + bad)], "series_id string, bar_date string, open string, high string, low string, close string, vol string, pct_chg string")
    got = {r.series_id: str(r.bar_date) for r in B.clean_bars(raw).collect()}
    assert got == {str(i): "2021-01-04" for i in range(len(texts))}


def test_several_bars_on_one_day_are_refused_or_reduced(spark):
    import pytest

    bars = daily(spark, [1, 2, 3])
    twice = bars.unionByName(bars.limit(1).withColumn("close", bars.close + 5))
    with pytest.raises(ValueError, match="2 bars on 2021-01-01"):
        B.clean_bars(twice)
    out = B.clean_bars(twice, on_duplicate="largest").orderBy("bar_date").collect()
    assert [r.close for r in out] == [6.0, 2.0, 3.0]
    assert B.clean_bars(bars).count() == 3
