"""Property tests against brute force (small random inputs)."""

import itertools
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelcast.functions.grid import Grid
from panelcast.operators import metrics as M
from panelcast.operators import splits as SP
from panelcast.operators import thresholds as T

GRID = Grid(0.30, 0.70, 0.01)
GRID_PTS = [0.30 + k * ((0.30 + 0.01) - 0.30) for k in range(GRID.size)]
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

score = st.one_of(st.sampled_from(GRID_PTS), st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]), st.floats(0.0, 1.0))
pairs_st = st.lists(st.tuples(st.integers(0, 1), score), min_size=1, max_size=60)


def _df(spark, pairs):
    return spark.createDataFrame([(int(g), int(y), float(p)) for g, (y, p) in pairs], "g int, y_true int, up_prob double")


@SETTINGS
@given(pairs=pairs_st)
def test_auc_equals_pairwise_definition(spark, pairs):
    tagged = [(i % 2, yp) for i, yp in enumerate(pairs)]
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(_df(spark, tagged), ["g"], parts=3).collect()}
    for g in got:
        sub = [yp for gg, yp in tagged if gg == g]
        pos = [p for y, p in sub if y == 1]
        neg = [p for y, p in sub if y == 0]
        if not pos or not neg:
            assert got[g] is None
        else:
            want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))
            assert math.isclose(got[g], want, rel_tol=1e-12, abs_tol=1e-12)


@SETTINGS
@given(pairs=pairs_st)
def test_sweep_equals_brute_force(spark, pairs):
    rows = {r["k"]: r for r in T.threshold_sweep(_df(spark, [(0, yp) for yp in pairs]), ["g"]).collect()}
    assert len(rows) == GRID.size
    for k, t in enumerate(GRID_PTS):
        tp = sum(1 for y, p in pairs if p >= t and y == 1)
        fp = sum(1 for y, p in pairs if p >= t and y == 0)
        assert (rows[k]["tp"], rows[k]["fp"]) == (tp, fp)


def _folds_brute(n):
    """The fold loop written out directly from its definition."""
    val_len = max(int(n * 0.15), 40)
    test_len = max(int(n * 0.15), 40)
    train_len = max(int(n * 0.7), 120)
    train_len = max(min(train_len, n - val_len - test_len - 2 * 20), 120)
    remain = n - (train_len + val_len + test_len)
    step = max(remain // 2, 20)
    cuts, start = [], 0
    while start + train_len + val_len + test_len <= n:
        cuts.append((start, start + train_len, start + train_len + val_len, start + train_len + val_len + test_len))
        start += step
    return cuts if len(cuts) >= 2 else []


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(200, 900))
def test_fold_membership_equals_loop(spark, n):
    import datetime as dt

    d0 = dt.date(2020, 1, 1)
    frame = spark.createDataFrame([("s", d0 + dt.timedelta(days=i)) for i in range(n)], "series_id string, bar_date date")
    got = sorted((r["row_idx"], r["fold_id"], r["split"]) for r in SP.fold_membership(frame).collect())
    want = []
    for j, (a, b, c, d) in enumerate(_folds_brute(n)):
        for i in range(a, d):
            want.append((i, j + 1, "train" if i < b else "val" if i < c else "test"))
    assert got == sorted(want)
