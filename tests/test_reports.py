"""Consistency reports, run comparison, signal export and partitioned sinks."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from panelcast.operators import consistency as C
from panelcast.plans import publish as P
from panelcast.sources import store as ST


def _frame(spark, rows):
    return spark.createDataFrame(rows, "series_id string, bar_date date, f double, target_up int")


D = dt.date(2021, 1, 1)


def test_consistency_summary_counts_and_mismatches(spark):
    a = _frame(spark, [("s", D, 1.0, 1), ("s", D + dt.timedelta(1), 2.0, 0), ("s", D + dt.timedelta(2), None, 1)])
    b = _frame(spark, [("s", D, 1.5, 1), ("s", D + dt.timedelta(1), 2.0, 1), ("t", D, 9.0, 0)])
    r = C.consistency_summary(a, b, ["f"], names=("x", "y")).first()
    assert (r["x_rows"], r["y_rows"], r["joined_rows"], r["label_mismatch_count"]) == (3, 3, 2, 1)
    assert r["label_mismatch_rate"] == 0.5
    assert r["feature_mean_abs_diff_avg"] == 0.25 and r["feature_max_abs_diff_max"] == 0.5
    rows = {x["column"]: x for x in C.feature_consistency(a, b, ["f"], names=("x", "y")).collect()}
    assert rows["f"]["count"] == 2 and rows["f"]["x_mean"] == 1.5 and abs(rows["f"]["mean_rel_diff"] - 0.25 / 1.5) < 1e-12


def test_run_comparison_joins_on_metric(spark):
    a = spark.createDataFrame([(0.5, 3)], "final_f1 double, false_positive_count long")
    b = spark.createDataFrame([(0.75, 1)], "final_f1 double, false_positive_count long")
    rows = {r["metric"]: r for r in C.run_comparison(a, b, ["final_f1", "false_positive_count"], ("p", "q")).collect()}
    assert rows["final_f1"]["q_minus_p"] == 0.25 and rows["false_positive_count"]["q_minus_p"] == -2.0


def test_signal_export_latest_bar_and_stale_flag(spark):
    scored = spark.createDataFrame(
        [("a", D, 0, 0.7), ("a", D + dt.timedelta(2), 0, 0.4), ("b", D + dt.timedelta(1), 0, 0.9)],
        "series_id string, bar_date date, config_idx int, up_prob double",
    )
    thr = spark.createDataFrame([(0.5,)], "threshold double")
    out = {r["series_id"]: r for r in P.signal_export(scored, thr, "m1", "dataframe").collect()}
    assert out["a"]["trade_date"] == D + dt.timedelta(2) and out["a"]["y_pred"] == 0 and not out["a"]["is_stale"]
    assert out["b"]["y_pred"] == 1 and out["b"]["is_stale"]
    assert P.incomplete_signals(P.signal_export(scored, thr, "m1", "dataframe")).count() == 0


def test_partitioned_sink_prunes_on_read(spark):
    path = tempfile.mkdtemp(prefix="panelcast-part-") + "/preds"
    preds = spark.range(60).select(
        (F.col("id") % 3 + 1).cast("int").alias("fold_id"), (F.col("id") / 60.0).alias("up_prob")
    )
    ST.write_table(preds, path, partition_by=["fold_id"])
    back = spark.read.parquet(path).where(F.col("fold_id") == 2)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fold_id" in plan and back.count() == 20


def test_final_predictions_fail_when_no_config_qualifies(spark):
    import pytest

    from conftest import daily
    from panelcast.plans import evaluation as E

    frame = daily(spark, [float(i % 7 + 1) for i in range(60)]).withColumns(
        {"ma5": F.col("close"), "ma10": F.col("close"), "ret_5": F.lit(0.0), "target_up": F.lit(1)}
    )
    empty_best = spark.createDataFrame([], "config_idx int")
    with pytest.raises(Exception, match="no candidate"):
        E.final_predictions(frame, empty_best)


def test_run_comparison_of_whole_runs(spark):
    """Two records made of several scalar subqueries over predictions are compared in one plan."""
    from panelcast.plans import evaluation as E

    def record(shift):
        rows = [("s", "test", D + dt.timedelta(i), 0, i % 2, 0.0, ((i * 7 + shift) % 20) / 20.0) for i in range(20)]
        preds = spark.createDataFrame(rows, "series_id string, split string, bar_date date, config_idx int, y_true int, logit double, up_prob double")
        test = E.final_test_predictions(preds, spark.createDataFrame([(0.5,)], "threshold double"))
        return C.combine_rows(
            E.final_metrics(test, 0.5).select("f1", "roc_auc", "brier_score"),
            E.final_errors(test)[1].select("false_positive_count", "near_threshold_error_rate"),
        )

    metrics = ["f1", "roc_auc", "brier_score", "false_positive_count", "near_threshold_error_rate"]
    want = [record(shift).first() for shift in (0, 3)]
    got = {r["metric"]: r for r in C.run_comparison(record(0), record(3), metrics, ("p", "q")).collect()}
    assert sorted(got) == sorted(metrics)
    assert all((got[m]["p"], got[m]["q"]) == (want[0][m], want[1][m]) for m in metrics)
