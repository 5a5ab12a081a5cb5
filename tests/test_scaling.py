"""A stored scaler applied to rows: same values as scaling in place, and no shuffle of the rows."""

import datetime as dt

import pytest

from panelcast.operators.scaling import apply_scaler, fit_scaler, scale_rows, scale_stored_rows
from panelcast.operators.splits import FoldSpec, fold_membership, split_by_time, with_positions
from panelcast.plans import evaluation as E

ROWS = [(s, f, p, float(s * 10 + k * (f + 1)), float(k % 2)) for s in (1, 2, 3) for f in (1, 2) for k, p in enumerate(["train"] * 4 + ["val", "test"])]
SCHEMA = "series_id int, fold_id int, split string, a double, b double"


@pytest.fixture
def rows(spark):
    odd = [(None, 1, "train", 1.0, 1.0), (1, None, "train", 1.0, 1.0), (4, 1, "val", 1.0, 1.0), (1, 7, "test", 1.0, 1.0), ROWS[0]]
    return spark.createDataFrame(ROWS + odd, SCHEMA)


def plain(rows, keys):
    """Rows whose key has training rows, scaled in plain Python; a key with a NULL has no scaler."""
    from statistics import fmean, pstdev

    own = lambda r: tuple(r[k] for k in keys)
    stats = {}
    for r in rows:
        if r["split"] == "train" and None not in own(r):
            stats.setdefault(own(r), []).append(r)
    scale = lambda r, c: (r[c] - fmean(x[c] for x in stats[own(r)])) / (pstdev([x[c] for x in stats[own(r)]]) or 1.0)
    return sorted((r["series_id"], r["fold_id"] or 0, r["split"], round(scale(r, "a"), 9), round(scale(r, "b"), 9)) for r in rows if own(r) in stats)


@pytest.mark.parametrize("keys", [["series_id", "fold_id"], ["series_id"], ["fold_id"]])
def test_applied_scaler_equals_plain_python(rows, keys):
    known = rows.where("series_id is not null")
    scaler = fit_scaler(known, ["a", "b"], "panel", by=keys)
    out = apply_scaler(known, scaler, ["a", "b"], keys)
    assert out.columns == [*keys, *[c for c in rows.columns if c not in keys]]
    got = sorted((r["series_id"], r["fold_id"] or 0, r["split"], round(r["a"], 9), round(r["b"], 9)) for r in out.collect())
    assert got == plain(known.collect(), keys) and len(got) > 30


def test_rows_stay_in_their_partitioning(spark, rows):
    """Also where joins must be partitioned by all their keys: the folds of a series come as one row."""
    scaler = spark.createDataFrame(fit_scaler(rows, ["a", "b"]).collect(), "series_id int, fold_id int, feature string, mean double, scale double")
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "true", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        placed = rows.repartition(16, "series_id")
        plan = apply_scaler(placed, scaler, ["a", "b"], ["series_id", "fold_id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("REPARTITION_BY_NUM") == 1
    of_rows = plan.split("REPARTITION_BY_NUM")[0].splitlines()
    assert not any("hashpartitioning(series_id" in line and "fold_id" in line for line in of_rows[of_rows.index(next(x for x in of_rows if "Join" in x)) :][:4])


def _dated(spark):
    """Series of several lengths, one without a name, rows out of order, one feature with gaps."""
    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=d), float((d * 7 + (s or 5)) % 11) / 3, None if d % 9 == 4 else 0.1 * d, 0.1) for s, n in ((1, 70), (2, 45), (None, 60)) for d in range(n)]
    return spark.createDataFrame(rows[::-1], "series_id long, bar_date date, a double, b double, c double")


_SPEC = FoldSpec(min_gap=4, min_train=10, min_val=4, min_test=4)


@pytest.mark.parametrize("tag, by", [(lambda x: fold_membership(x, _SPEC), ["fold_id"]), (split_by_time, [])])
def test_stored_rows_are_scaled_as_by_windows(spark, tag, by):
    """To the last bit, and with the series that has no name."""
    frame = with_positions(_dated(spark))
    place = lambda r: (r["series_id"] or 0, r["bar_date"], r["fold_id"] if by else 0)
    want = scale_rows(tag(frame), ["a", "b", "c"], "series", by=by)
    got = scale_stored_rows(frame, ["a", "b", "c"], tag, by)
    assert got.columns == want.columns
    got, want = (sorted(x.collect(), key=place) for x in (got, want))
    assert got == want and len({r["series_id"] for r in got}) == 3


def test_rows_of_folds_go_through_no_window(spark):
    plan = E.rolling_scaled(_dated(spark), E.EvalSpec(features=["a", "b"], folds=_SPEC))._jdf.queryExecution().executedPlan().toString()
    assert not any("Window" in line and "fold_id" in line for line in plan.splitlines())


def test_a_window_takes_a_deviation_once(spark):
    plan = scale_rows(split_by_time(_dated(spark)), ["a"], "series", by=[])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("stddev_pop(") == 1
