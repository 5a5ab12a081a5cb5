import itertools
import random

from pyspark.sql import functions as F

from panelcast.functions.grid import Grid
from panelcast.operators import metrics as M
from panelcast.operators import thresholds as T
from panelcast.operators.scaling import scale_rows


def _preds(spark, pairs, group=1):
    return spark.createDataFrame([(group, int(y), float(p)) for y, p in pairs], "g int, y_true int, up_prob double")


def _auc_brute(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    if not pos or not neg:
        return None
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def test_auc_matches_pairwise_with_ties(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(400)]
    got = M.roc_auc(_preds(spark, pairs), ["g"], parts=7).first()["roc_auc"]
    assert abs(got - _auc_brute(pairs)) < 1e-12


def test_auc_one_class_is_null_and_rates_zero(spark):
    pairs = [(0, 0.2), (0, 0.7), (0, 0.9)]
    assert M.roc_auc(_preds(spark, pairs), ["g"]).first()["roc_auc"] is None
    r = M.classification_metrics(_preds(spark, pairs), ["g"], 0.5).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_prefix_sums_match_brute_force_across_partitions(spark):
    rnd = random.Random(5)
    rows = [(g, float(i), rnd.randint(0, 5)) for g in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, o double, v int")
    got = {(r["g"], r["o"]): r["v_before"] for r in M.prefix_sums(df, ["g"], "o", ["v"], parts=9).collect()}
    for g in range(3):
        acc = 0
        for i in range(200):
            assert got[(g, float(i))] == acc
            acc += [r for r in rows if r[0] == g and r[1] == float(i)][0][2]


def test_grid_points():
    g = Grid(0.30, 0.70, 0.01)
    assert g.size == 41


def test_grid_point_doubles(spark):
    g = Grid(0.30, 0.70, 0.01)
    pts = spark.range(g.size).select(g.point(F.col("id")).alias("t")).collect()
    assert len(pts) == 41 and pts[6]["t"] == 0.36000000000000004


def test_sweep_matches_brute_force_including_grid_edges(spark):
    rnd = random.Random(2)
    g = Grid(0.30, 0.70, 0.01)
    grid_pts = [0.30 + k * ((0.30 + 0.01) - 0.30) for k in range(g.size)]
    pairs = [(rnd.randint(0, 1), rnd.random()) for _ in range(300)] + [(rnd.randint(0, 1), p) for p in grid_pts[::3]]
    opts = T.TuneOptions()
    sweep = {r["k"]: r for r in T.threshold_sweep(_preds(spark, pairs), ["g"], opts).collect()}
    for k, t in enumerate(grid_pts):
        tp = sum(1 for y, p in pairs if p >= t and y == 1)
        fp = sum(1 for y, p in pairs if p >= t and y == 0)
        assert (sweep[k]["tp"], sweep[k]["fp"]) == (tp, fp), k
        assert sweep[k]["threshold"] == round(t, 2)


def test_anchor_tie_prefers_smaller_double_distance(spark):
    cands = spark.createDataFrame([(1, 0, 0.45, 0.6, 0.5), (1, 1, 0.55, 0.6, 0.5)], "g int, k int, threshold double, score double, f1 double")
    best = T.stable_pick(cands, ["g"], "score", "threshold", "f1", "k", 0.01, 0.5).first()
    assert best["threshold"] == 0.45  # abs(0.45 - 0.5) < abs(0.55 - 0.5) in doubles


def test_snap_and_median(spark):
    from panelcast.functions.columns import snap_to_grid

    df = spark.createDataFrame([(0.395,), (0.2,), (0.9,), (0.333,)], "x double")
    got = [r[0] for r in df.select(snap_to_grid(F.col("x"), 0.30, 0.70, 0.01)).collect()]
    assert got == [round(0.30 + round((min(max(x, 0.3), 0.7) - 0.3) / 0.01) * 0.01, 2) for x in (0.395, 0.2, 0.9, 0.333)]
    rows = spark.createDataFrame([(0.33,), (0.68,), (0.45,), (0.50,)], "best_threshold double")
    r = T.final_threshold(rows, []).first()
    assert abs(r["median_threshold"] - (0.45 + 0.50) / 2) < 1e-15
    empty = rows.where(F.lit(False))
    assert T.final_threshold(empty, []).first()["final_threshold"] == 0.5


def test_constant_feature_scales_to_one(spark):
    rows = [("s", 1, "train", 5.0), ("s", 1, "train", 5.0), ("s", 1, "val", 7.0)]
    df = spark.createDataFrame(rows, "series_id string, fold_id int, split string, x double")
    out = sorted(r["x"] for r in scale_rows(df, ["x"], "series", by=["fold_id"]).collect())
    assert out == [0.0, 0.0, 2.0]
    out = sorted(r["x"] for r in scale_rows(df, ["x"], "panel", by=["fold_id"]).collect())
    assert out == [0.0, 0.0, 2.0]


def test_fbeta_formula(spark):
    pairs = [(1, 0.9), (1, 0.2), (0, 0.8), (0, 0.1), (1, 0.7)]
    r = M.classification_metrics(_preds(spark, pairs), ["g"], 0.5, beta=0.5).first()
    tp, fp, fn = 2, 1, 1
    assert r["f1"] == 2 * tp / (2 * tp + fp + fn)
    assert abs(r["fbeta"] - 1.25 * tp / (1.25 * tp + 0.25 * fn + fp)) < 1e-15


def test_weighted_log_loss_with_logits(spark):
    import math as m

    rows = [(1, 1, 2.0, 1.0), (1, 0, -1.0, 3.0), (1, 1, -0.5, 2.0)]
    df = spark.createDataFrame(rows, "g int, y_true int, logit double, w double")
    got = M.log_loss(df, ["g"], weight_col="w").first()["log_loss"]

    def bce(y, x):
        return max(x, 0) - x * y + m.log1p(m.exp(-abs(x)))

    want = sum(bce(y, x) * w for _, y, x, w in rows) / sum(w for *_, w in rows)
    assert abs(got - want) < 1e-12
    plain = M.log_loss(df, ["g"]).first()["log_loss"]
    assert abs(plain - sum(bce(y, x) for _, y, x, _ in rows) / 3) < 1e-12
