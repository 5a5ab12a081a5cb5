"""Model layer on the smallest panel with a tiny iteration cap."""

import os

import pytest
from pyspark.sql import functions as F

from panelcast.operators import metrics as M
from panelcast.operators import splits as SP
from panelcast.plans import evaluation as E
from panelcast.plans import models as MD
from panelcast.plans.registry import training_frame

SF = "/root/testdata/sf0.001"
QUICK = MD.FitOptions(max_iter=5, seed=42)


@pytest.fixture(scope="module")
def training(spark):
    if not os.path.exists(f"{SF}/lineitem.parquet"):
        pytest.skip("test data not present")
    return training_frame(spark, SF)


def test_rolling_mlp_fold_rows(training):
    grid = MD.MLP_GRID[2:]
    run = MD.rolling_mlp(training, E.EvalSpec(), grid, QUICK)
    rows = run.fold_rows.collect()
    assert len(rows) == 3
    for r in rows:
        assert r["config_idx"] in {c.config_idx for c in grid}
        assert 0.0 <= r["test_f1"] <= 1.0 and 0.30 <= r["best_threshold"] <= 0.70
    assert run.config_rows.count() == 3 * len(grid)


def test_isotonic_calibration_gives_probabilities(training):
    frame = E.eval_frame(training)
    tagged = SP.split_by_time(frame)
    from panelcast.operators.scaling import scale_rows

    scaled = scale_rows(tagged, E.EvalSpec().features, "series", by=[])
    opts = MD.FitOptions(max_iter=5, seed=1, calibration="isotonic", calib_cv=2)
    score = MD.fit_prob_model(scaled.where(F.col("split") == "train"), E.EvalSpec().features, MD.MLP_GRID[3], opts)
    out = score(scaled.where(F.col("split") == "test"))
    r = out.agg(F.min("up_prob").alias("lo"), F.max("up_prob").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    assert 0.0 <= r["lo"] <= r["hi"] <= 1.0 and r["n"] == scaled.where(F.col("split") == "test").count()


def test_logreg_baseline_one_row(training):
    row = MD.logreg_baseline(training, E.EvalSpec(), QUICK).first()
    assert row["model"] == "logreg" and 0.0 <= row["accuracy"] <= 1.0


def test_confusion_matrix_record(spark):
    preds = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.1)], "y_true int, up_prob double")
    rec = M.with_confusion_matrix(M.confusion(preds, [], 0.5)).first()
    assert [list(x) for x in rec["confusion_matrix"]] == [[0, 1], [1, 1]]


def test_strict_series_check_raises(spark):
    from conftest import daily

    report = SP.series_report(daily(spark, range(30), series="short"))
    assert SP.check_series(report).count() == 1
    with pytest.raises(ValueError, match="short"):
        SP.check_series(report, strict=True)


def test_short_series_are_named_end_to_end(spark):
    from conftest import daily

    from panelcast.operators import features as feat

    bars = daily(spark, range(1, 300), series="long").unionByName(daily(spark, range(1, 31), series="short")).unionByName(daily(spark, [1, 2], series="tiny"))
    frame = feat.finalize(feat.build_features(bars))
    assert {r[0] for r in frame.select("series_id").distinct().collect()} == {"long", "short"}
    report = SP.series_report(frame, series=bars)
    bad = {r["series_id"]: (r["n_rows"], r["reason"]) for r in SP.check_series(report).collect()}
    assert bad == {"short": (21, "fewer than 50 rows"), "tiny": (0, "fewer than 50 rows")}
    with pytest.raises(ValueError, match="short|tiny"):
        SP.check_series(report, strict=True)
    with pytest.raises(ValueError, match="no series"):
        E.tuning_inputs(frame.where("series_id = 'short'"))
    assert {r[0] for r in SP.long_enough(frame).select("series_id").distinct().collect()} == {"long"}


def test_calibration_folds_are_stratified_blocks(spark):
    from conftest import daily

    rows = daily(spark, range(1, 92)).selectExpr("series_id", "bar_date", "int(close) % 3 = 0 as t").selectExpr("series_id", "bar_date", "int(t) as target_up")
    got = MD.stratified_folds(rows, 3).collect()
    for label in (0, 1):
        own = [r["_cv"] for r in sorted(got, key=lambda r: r.bar_date) if r.target_up == label]
        assert own == sorted(own) and max(own.count(k) for k in range(3)) - min(own.count(k) for k in range(3)) <= 1


def test_intermediates_are_pruned_and_released(spark):
    from panelcast import session

    df = spark.range(1000).selectExpr("id", "id % 3 as fold_id", "if(id % 2 = 0, 'train', 'val') as split", "id * 2 as x")
    made = session.materialize(df, partition_by=["fold_id", "split"])
    assert made.columns == df.columns
    plan = made.where("fold_id = 1 and split = 'val'").select("x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fold_id" in plan and "ReadSchema: struct<x:bigint>" in plan
    assert session.release(spark) >= 1 and session.release(spark) == 0


def test_run_store_keeps_fits_by_content(spark, training, tmp_path, monkeypatch):
    """A second run reads the networks; another option, configuration or row fits anew."""
    from panelcast.operators import perceptron as P
    from panelcast.plans.run_store import RunStore

    fitted = []
    fit_all = P.fit_all
    monkeypatch.setattr(P, "fit_all", lambda blocks, fits, *rest: fitted.append(sorted(f.name for f in fits)) or fit_all(blocks, fits, *rest))
    store, spec, grid = RunStore(spark, str(tmp_path)), E.EvalSpec(), MD.MLP_GRID[3:]
    first = MD.rolling_mlp(training, spec, grid, QUICK, store)
    assert fitted == [["1/3", "2/3", "3/3"], ["1/refit", "2/refit", "3/refit"]]
    again = MD.rolling_mlp(training.repartition(3), spec, grid, QUICK, store)
    assert len(fitted) == 2 and sorted(map(str, first.fold_rows.collect())) == sorted(map(str, again.fold_rows.collect()))
    MD.rolling_mlp(training, spec, [MD.MLP_GRID[2], *grid], QUICK, store)
    assert fitted[2] == ["1/2", "2/2", "3/2"]
    fitted.clear()
    MD.rolling_mlp(training.withColumn("target_up", 1 - F.col("target_up")), spec, grid, QUICK, store)
    assert fitted[0] == ["1/3", "2/3", "3/3"]
    fitted.clear()
    MD.rolling_mlp(training, spec, grid, MD.FitOptions(max_iter=4), store)
    assert fitted[0] == ["1/3", "2/3", "3/3"]


def test_broken_off_entry_is_not_read(spark, tmp_path):
    from panelcast.operators import perceptron as P
    from panelcast.plans.run_store import RunStore

    store = RunStore(spark, str(tmp_path))
    model = P.Perceptron([2, 1], P.initial_weights([2, 1], 1), 0.1, 3, 5, 0.5, None, "limit")
    store.put("k", model)
    assert store.get("k").row() == model.row() and store.get("other") is None
    os.remove(tmp_path / "k" / "_SUCCESS")
    assert store.get("k") is None


def test_penalties_give_different_fits_and_results_say_what_was_fitted(training):
    grid = [MD.MlpConfig(0, (8,), 50.0), MD.MlpConfig(1, (8,), 1e-4)]
    run = MD.rolling_mlp(training, E.EvalSpec(), grid, QUICK)
    rows = {(r["fold_id"], r["config_idx"]): r for r in run.config_rows.collect()}
    for f in (1, 2, 3):
        a, b = rows[f, 0], rows[f, 1]
        assert a["train_loss_last"] != b["train_loss_last"] and a["val_loss_best"] != b["val_loss_best"]
        assert 1 <= a["iterations"] <= a["steps_run"] <= QUICK.max_iter and a["fit_ended"]


def test_saved_model_scores_alike(spark, training, tmp_path):
    frame, model, scaler = MD.fit_for_latest(training, E.EvalSpec(), MD.MLP_GRID[3], QUICK)
    MD.save_model(model, spark.createDataFrame([(0.5,)], "threshold double"), str(tmp_path))
    loaded, settings = MD.load_model(spark, str(tmp_path))
    a, b = (MD.predict_latest(frame, scaler, m, E.EvalSpec().features, settings.first()["threshold"], 20).orderBy("series_id").collect() for m in (model, loaded))
    assert a == b and a


def test_sequence_model_reports_its_losses(training):
    run = MD.train_sequence_model(training, E.EvalSpec(), (4,), QUICK)
    row = run.metrics.first()
    assert row["train_loss_last"] > 0 and row["val_loss_best"] > 0 and row["iterations"] <= 5
    assert run.predictions.count() == row["sequence_samples"]["test"]


def test_rows_are_packed_once_for_tuning_and_refit(training, monkeypatch):
    """The refit learns from the rows that tuning left on the cluster."""
    from panelcast.operators import perceptron as P

    made, ready = [], P.ready
    monkeypatch.setattr(P, "ready", lambda blocks: made.append(ready(blocks)) or made[-1])
    run = MD.rolling_mlp(training, E.EvalSpec(), MD.MLP_GRID[3:], QUICK)
    assert len(made) == 1
    MD.final_mlp(training, MD.MLP_GRID[3], run.fold_rows, E.EvalSpec(), QUICK)
    assert len(made) == 2
    MD.fit_for_latest(training, E.EvalSpec(), MD.MLP_GRID[3], QUICK)
    assert len(made) == 3 and not any(rows.getStorageLevel().useMemory for rows, _ in made)
